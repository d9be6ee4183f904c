from math import log

import numpy as np
import pytest
from fixtures import documents, nothing, rows, texts
from pyspark.sql import functions as F

from hirelens.llm import language_id as lid

PIECES = ["a", "ab", "b", "bc", "c", "▁", "▁a", "▁ab", "cab"]


def segmentations(text, pieces):
    if not text:
        yield []
    for n in range(1, len(text) + 1):
        if text[:n] in pieces or n == 1:
            for rest in segmentations(text[n:], pieces):
                yield [text[:n], *rest]


def brute(word, p):
    """Sum over all segmentations of the product; letters outside the vocabulary have the weight of the last piece."""
    return sum(float(np.prod([p[PIECES.index(x) if x in PIECES else len(PIECES)] for x in s])) for s in segmentations("▁" + word, PIECES))


def weights(seed=0, languages=2):
    rng = np.random.default_rng(seed)
    p = rng.random((len(PIECES) + 2, languages))
    p[-1] = 0
    return p / p.sum(axis=0)


def test_forward_sums_all_segmentations():
    p, pieces = weights(), lid.Pieces.of(PIECES, 3)
    words = ["a", "ab", "abc", "cabab", "abcabcx", "é", "bcbcbcab", "aaaa"]
    scores = lid.word_scores(words, pieces, p)
    for w, row in zip(words, scores):
        for k in range(2):
            assert row[k] == pytest.approx(log(brute(w, p[:, k])), abs=1e-9)


def test_long_words_do_not_underflow():
    p, pieces = weights(), lid.Pieces.of(PIECES, 3)
    one, two = lid.word_scores(["ab" * 2000, "ab" * 4000], pieces, p)
    assert np.isfinite(one).all() and (two < 1.9 * one).all()


def test_expected_counts():
    p, pieces = weights(1, 1), lid.Pieces.of(PIECES, 3)
    counts = lid.expected_counts(["abcab", "cab"], np.array([2.0, 1.0]), pieces, p)
    wanted = np.zeros(len(counts))
    for word, n in (("abcab", 2), ("cab", 1)):
        for s in segmentations("▁" + word, PIECES):
            share = float(np.prod([p[PIECES.index(x), 0] for x in s])) / brute(word, p[:, 0])
            for x in s:
                wanted[PIECES.index(x)] += n * share
    assert np.allclose(counts, wanted)


def test_words_are_letters():
    assert lid.words_of("Ab1c d_e É² 漢字! x") == ["ab", "c", "d", "e", "é", "漢字", "x"]


def test_languages_are_told_apart(spark):
    en = ["the cat and the dog are in the house with many things", "this is what they said about the weather"]
    de = ["der hund und die katze sind nicht in dem haus", "das ist was sie über das wetter gesagt haben"]
    rows_ = [(i, t, lang) for i, (t, lang) in enumerate([(t, "en") for t in en * 10] + [(t, "de") for t in de * 10])]
    rows_ += [(100, "die katze und das wetter", None), (101, "the dog and the weather", None), (102, None, "en"), (103, "12 + 3!", "de"), (104, "", None)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in lid.identify(docs, F.col("doc_id") < 100).collect()}
    assert found[100].lang_pred == "de" and found[101].lang_pred == "en" and found[100].score > 0.9
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (102, 103, 104))


def test_awkward_tables(spark):
    found = lid.identify(documents(spark), F.lit(True)).collect()
    assert len(found) == len(rows(texts())) and all(0 <= r.score <= 1 for r in found)
    assert {r.lang_pred for r in lid.identify(documents(spark), F.lit(False)).collect()} == {"und"}
    assert lid.identify(nothing(spark), F.lit(True)).count() == 0


def test_every_letter_piece_of_the_vocabulary_is_used():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=lid.VOCABULARY)
    every = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    names = lid.pieces_of(lid.VOCABULARY)
    assert set(names) == {x for x in every if x == lid.START or x.removeprefix(lid.START).isalpha()}
    longest = max(map(len, names))
    pieces = lid.Pieces.of(names, longest)
    assert longest > 8 and sum(len(known) for known, _ in pieces.tables) == len(names)
    p = np.full((len(names) + 2, 1), 1e-9)
    p[names.index("▁information")], p[-1] = 0.5, 0
    assert lid.word_scores(["information"], pieces, p)[0, 0] == pytest.approx(log(0.5), abs=1e-6)


def test_rare_letters_between_scalings_do_not_underflow():
    p, pieces = np.full((len(PIECES) + 2, 1), 1e-11), lid.Pieces.of(PIECES, 16)
    p[-1] = 0
    assert np.isfinite(lid.word_scores(["x" * 200], pieces, p)).all()


def test_words_of_every_length_are_learnt_from():
    p, pieces = weights(1, 1), lid.Pieces.of(PIECES, 3)
    for word in ("abcabx" * 7, "a" * 31, "cab" * 2000):
        counts = lid.expected_counts([word], np.array([2.0]), pieces, p)
        letters = sum(c * len(x) for c, x in zip(counts, [*PIECES, "x"]))
        assert letters == pytest.approx(2 * (len(word) + 1))
    # Against plain sums, which 42 letters do not underflow.
    text = "▁" + "abcabx" * 7
    of = {x: p[i, 0] for i, x in enumerate(PIECES)}
    part = lambda x: of.get(x, p[len(PIECES), 0] if x == "x" else 0.0)
    before, after = [1.0] + [0.0] * len(text), [0.0] * len(text) + [1.0]
    for end in range(1, len(text) + 1):
        before[end] = sum(before[end - n] * part(text[end - n:end]) for n in (1, 2, 3) if n <= end)
    for at in reversed(range(len(text))):
        after[at] = sum(part(text[at:at + n]) * after[at + n] for n in (1, 2, 3) if at + n <= len(text))
    found = lid.expected_counts(["abcabx" * 7], np.array([1.0]), pieces, p)
    for i, x in enumerate(PIECES):
        wanted = sum(before[at] * of[x] * after[at + len(x)] for at in range(len(text)) if text.startswith(x, at)) / before[-1]
        assert found[i] == pytest.approx(wanted)
