"""Language identification by unigrams over vocabulary pieces, summed over all segmentations.

A word is its letters in lower case behind a mark for its start. Its probability in a language is the sum, over all ways
to cut it into pieces of a fixed public vocabulary, of the product of the pieces' probabilities; the
forward algorithm computes it. The probabilities of each language are estimated by expectation-maximisation with the same sums, on
the words of a bounded sample of labelled texts. A text's score is the posterior of its language, with the
sample's language frequencies as prior.

Pieces never cross words, so a task scores each different word once, all words of a length together in numpy arrays.
Every whole text is scored. The work of a word is linear in its length.

Nulls and texts without a letter are `und` with score 0, and so is every text if there is nothing to learn from.
Repeated rows are scored alike. Columns of the input other than id, text and language are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.base import Scratch

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
START = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)
UNDECIDED = "und"
#: Letters after which the sums over a word are scaled, before they underflow.
EVERY = 8


@dataclass(frozen=True)
class Fit:
    """About `sample` labelled documents of each language are learnt from, in `rounds` rounds; `smoothing` is added to the count of every piece and `unknown` is the weight of a
    letter outside the vocabulary. A task remembers the scores of `remembered` words."""

    sample: int = 1500
    rounds: int = 3
    smoothing: float = 0.05
    unknown: float = 0.01
    remembered: int = 300_000


def pieces_of(path: str) -> list[str]:
    """All of the vocabulary's pieces that consist of letters, in lower case, with or without the mark of a word's start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in every if p == START or p.removeprefix(START).isalpha())


def hashes(letters: np.ndarray, width: int, shorter: np.ndarray | None) -> np.ndarray:
    """Hashes of all substrings of a width, from those that are one shorter."""
    if shorter is None:
        return (letters + np.uint64(1)) * BASE
    return shorter[:, :-1] * BASE + letters[:, width - 1:] + np.uint64(1)


@dataclass(frozen=True)
class Pieces:
    """Piece hashes by length, sorted, and the number of each piece; `n` is the number of the unknown letter."""

    tables: list[tuple[np.ndarray, np.ndarray]]
    n: int

    @staticmethod
    def of(pieces: list[str], longest: int) -> Pieces:
        tables = []
        for width in range(1, longest + 1):
            numbers = np.array([i for i, p in enumerate(pieces) if len(p) == width], np.int64)
            letters = np.array([[ord(c) for c in pieces[i]] for i in numbers], np.uint64).reshape(-1, width)
            got = None
            for w in range(1, width + 1):
                got = hashes(letters, w, got)
            got = got[:, 0] if len(numbers) else np.zeros(0, np.uint64)
            order = np.argsort(got)
            tables.append((got[order], numbers[order]))
        return Pieces(tables, len(pieces))

    def numbers(self, letters: np.ndarray) -> list[np.ndarray]:
        """For each width the piece at every place: n + 1 where there is none, n for an unknown letter."""
        found, got = [], None
        for width, (known, number) in enumerate(self.tables, 1):
            if width > letters.shape[1]:
                break
            got = hashes(letters, width, got)
            at = np.searchsorted(known, got)
            at[at == len(known)] = 0
            hit = known[at] == got if len(known) else np.zeros(got.shape, bool)
            none = self.n if width == 1 else self.n + 1
            found.append(np.where(hit, number[at] if len(known) else none, none))
        return found


def forward(numbers: list[np.ndarray], size: int, p: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sums over the segmentations of all beginnings, one row per word, for each column of p.

    Comes with the logarithms of the scale, first and after every EVERY letters: the last is that of the whole word, `logs` applies
    them to all beginnings. The last row of p is 0.
    """
    words, languages = len(numbers[0]), p.shape[1]
    sums = np.zeros((size + 1, words, languages))
    sums[0], scales, longest = 1.0, [np.zeros((words, languages))], len(numbers)
    for end in range(1, size + 1):
        for width in range(1, min(end, longest) + 1):
            sums[end] += sums[end - width] * p[numbers[width - 1][:, end - width]]
        if end % EVERY == 0:
            begin = max(0, end - longest + 1)
            top = sums[begin:end + 1].max(axis=0)
            sums[begin:end + 1] /= top
            scales.append(scales[-1] + np.log(top))
    return sums, scales


def logs(sums: np.ndarray, scales: list[np.ndarray], longest: int) -> np.ndarray:
    """Logarithms of the sums of `forward`; a beginning has the scale of the last time that it was among the `longest` latest."""
    with np.errstate(divide="ignore"):
        out = np.log(sums)
    for at in range(len(sums)):
        out[at] += scales[min(at + longest - 1, len(sums) - 1) // EVERY]
    return out


def grouped(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of equal length together: their numbers in the list, and their marked letters as code points.

    A block holds about a million letters at most, but at least one word.
    """
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        every = np.flatnonzero(sizes == size)
        step = max(1, 1_000_000 // int(size + 1))
        for at in range(0, len(every), step):
            some = every[at:at + step]
            text = "".join([START + words[i] for i in some])
            yield some, np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64).reshape(len(some), -1)


def word_scores(words: list[str], pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language."""
    out = np.zeros((len(words), p.shape[1]))
    for some, letters in grouped(words):
        size = letters.shape[1]
        sums, scales = forward(pieces.numbers(letters), size, p)
        out[some] = np.log(sums[size]) + scales[-1]
    return out


def expected_counts(words: list[str], times: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """How often each piece is expected in words that occur so many times, in one language; p has one column."""
    counts = np.zeros(pieces.n + 2)
    for some, letters in grouped(words):
        size, numbers = letters.shape[1], pieces.numbers(letters)
        before = logs(*forward(numbers, size, p), len(numbers))[..., 0]
        after = logs(*forward([n[:, ::-1] for n in numbers], size, p), len(numbers))[..., 0]
        for width, number in enumerate(numbers, 1):
            for begin in range(size - width + 1):
                n = number[:, begin]
                gain = np.exp(before[begin] + after[size - begin - width] - before[size]) * p[n, 0] * times[some]
                counts += np.bincount(n, gain, len(counts))
    counts[-1] = 0
    return counts


def words_of(text: str) -> list[str]:
    """The words of letters in a text, in lower case."""
    found = LETTERS.findall(text.lower())
    return found if text.isascii() else [x for w in found for x in ([w] if w.isalpha() else _letters(w))]


def _letters(word: str) -> list[str]:
    """The pattern takes numbers such as superscripts for letters; leave them out."""
    kept = "".join(c if c.isalpha() else " " for c in word)
    return kept.split()


@dataclass(frozen=True)
class Model:
    languages: list[str]
    prior: np.ndarray
    pieces: Pieces
    p: np.ndarray  # piece by language, a row for the unknown letter, a row of zeros


def fit(labelled: DataFrame, scratch: Scratch, vocabulary: str = VOCABULARY, how: Fit = Fit()) -> Model:
    """Learn from rows with `text` and `lang`, both not null.

    Counts of words and expected counts of pieces are summed by Spark; the driver gets one number per language and piece.
    """
    known = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    prior = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    languages = sorted(prior)
    # The share to draw comes as a literal map: a join on the language would send all texts to a few tasks.
    shares = F.create_map(*[F.lit(x) for lang, n in prior.items() for x in (lang, min(1.0, how.sample / n))]) if prior else None
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(drawn < F.try_element_at(shares, F.col("lang")) if prior else F.lit(False)).select("lang", "text")
    count = scratch.keep(
        sample.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    names = pieces_of(vocabulary)
    pieces = Pieces.of(names, max(map(len, names)))
    p = np.full((pieces.n + 2, len(languages)), 1.0 / (pieces.n + 1))
    p[-1] = 0
    for _ in range(how.rounds if languages else 0):
        totals = np.full(p.shape, how.smoothing)
        totals[pieces.n] = how.unknown
        step = _expectations(languages, pieces, p)
        for r in count.mapInArrow(step, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect():
            totals[r.piece, languages.index(r.lang)] += r.n
        totals[-1] = 0
        p = totals / totals.sum(axis=0)
    return Model(languages, np.array([prior[x] for x in languages], float), pieces, p)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from collections import Counter, defaultdict

    for batch in batches:
        counts: dict[str, Counter] = defaultdict(Counter)
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[lang].update(words_of(text))
        rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])


def _expectations(languages: list[str], pieces: Pieces, p: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, words = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            times = batch.column(2).to_numpy()
            for k, lang in enumerate(languages):
                own = np.flatnonzero(langs == lang)
                if not len(own):
                    continue
                counts = expected_counts([words[i] for i in own], times[own], pieces, p[:, [k]])
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(counts[some])],
                    ["lang", "piece", "n"])

    return run


def predict(docs: DataFrame, model: Model, how: Fit = Fit()) -> DataFrame:
    """doc_id, lang_pred and score of every row of `doc_id` and `text`."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, int] = {}
        scores = np.zeros((0, len(model.languages)))
        prior = np.log(model.prior / model.prior.sum()) if model.languages else np.zeros(0)
        for batch in batches:
            texts = batch.column(1)
            best, sure = [], []
            flat: list[int] = []
            ends: list[int] = []

            def finish() -> None:
                nonlocal scores
                if len(numbers) > len(scores):
                    new = list(numbers)[len(scores):]
                    scores = np.concatenate([scores, word_scores(new, model.pieces, model.p)])
                if ends:
                    total = np.concatenate([np.zeros((1, len(prior))), np.cumsum(scores[flat], axis=0)])
                    whole = np.diff(total[[0, *ends]], axis=0) + prior
                    odds = np.exp(whole - whole.max(axis=1, keepdims=True))
                    odds /= odds.sum(axis=1, keepdims=True)
                    empty = np.diff([0, *ends]) == 0
                    top = odds.argmax(axis=1)
                    best.extend(UNDECIDED if e else model.languages[t] for e, t in zip(empty, top))
                    sure.extend(np.where(empty, 0.0, odds[np.arange(len(top)), top]).tolist())
                flat.clear(), ends.clear()
                if len(numbers) > how.remembered:
                    numbers.clear()
                    scores = scores[:0]

            number = numbers.setdefault
            for i in range(len(texts) if model.languages else 0):
                text = texts[i].as_py()
                flat.extend([number(w, len(numbers)) for w in words_of(text or "")])
                ends.append(len(flat))
                if len(flat) > 200_000:
                    finish()
            finish()
            if not model.languages:
                best, sure = [UNDECIDED] * len(texts), [0.0] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(sure, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame, learnt: Column, vocabulary: str = VOCABULARY, how: Fit = Fit()) -> DataFrame:
    """Learn from the rows where `learnt` holds and predict all rows."""
    scratch = Scratch(docs.sparkSession, "language-id")
    model = fit(docs.filter(learnt).select("doc_id", "text", "lang"), scratch, vocabulary, how)
    scratch.close()
    return predict(docs, model, how)
