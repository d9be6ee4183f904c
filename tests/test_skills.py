import random

from pyspark.sql import functions as F

from hirelens.fixed_values import SKILL_LEXICON
from hirelens.functions import skills
from hirelens.operators import labels


def word(char):
    return char.isalnum() or char == "_"


def brute_force(text, lexicon):
    """Compare every place with every term."""
    low, found = text.lower(), set()
    for term in {t.lower() for t in lexicon}:
        last = 0
        for at in range(len(text)):
            end = at + len(term)
            if at < last or low[at:end] != term:
                continue
            before = at > 0 and word(text[at - 1])
            after = end < len(text) and word(text[end])
            if before != word(text[at]) and after != word(text[end - 1]):
                found.add((at, end))
                last = end
    return sorted(found)


def as_pairs(rows):
    return [[(s["start"], s["end"]) for s in spans] for spans in rows]


def test_spans_of_a_sentence(evaluate):
    text = "Thành thạo ASP.NET, C# và React Native"
    assert as_pairs(evaluate(skills.skill_spans, [text])) == [[(14, 18), (26, 31), (26, 38)]]
    kept = evaluate(lambda c: skills.non_overlapping(skills.skill_spans(c)), [text])
    assert as_pairs(kept) == [[(14, 18), (26, 31)]]
    assert evaluate(skills.tag_skills, [text, "", None, "SQL sql"]) == [[".NET", "React"], [], [], ["SQL", "sql"]]


def test_spans_equal_brute_force(evaluate):
    rng = random.Random(7)
    pieces = SKILL_LEXICON + ["React", "Native", " ", " ", ".", ",", "_", "é", "Đ", "😀", "x", "9", "\x01", "GitLab CI/CD", " "]
    texts = ["".join(rng.choice([p, p.upper(), p.lower()]) for p in rng.choices(pieces, k=rng.randint(0, 30)))
             for _ in range(400)]
    spans = as_pairs(evaluate(skills.skill_spans, texts))
    assert spans == [brute_force(t, SKILL_LEXICON) for t in texts]
    assert sum(map(len, spans)) > 200


def test_long_text_with_many_spans(evaluate):
    text = "go, React Native. " * 20_000
    (spans,) = as_pairs(evaluate(skills.skill_spans, [text]))
    assert len(spans) == 60_000
    assert spans == sorted({(a + 18 * i, b + 18 * i) for i in range(20_000) for a, b in ((0, 2), (4, 9), (4, 16))})
    (kept,) = as_pairs(evaluate(lambda c: skills.non_overlapping(skills.skill_spans(c)), [text]))
    assert len(kept) == 40_000
    assert all(a[1] <= b[0] for a, b in zip(kept, kept[1:]))


def test_layers_hold_no_overlaps():
    parts = skills.layers(SKILL_LEXICON)
    assert sorted(sum(parts, [])) == sorted({t.lower() for t in SKILL_LEXICON})
    assert len(parts) == 2
    assert skills.layers(["a b", "b c", "c"]) == [["a b", "c"], ["b c"]]


def test_other_lexicon(evaluate):
    lexicon = ["the end", "end", "e"]
    texts = ["The END", "the end e", "bend", "e-e"]
    assert as_pairs(evaluate(skills.skill_spans, texts, lexicon=lexicon)) == [brute_force(t, lexicon) for t in texts]


def test_label_sentences(spark):
    df = spark.createDataFrame(
        [("<b>Python</b> and go. Nothing here. Python and go.",), ("Python and go.",), (None,), ("",)], "t string")
    rows = labels.label_sentences(df, F.col("t")).collect()
    assert [(r.text, [tuple(e) for e in r.entities]) for r in rows] == [
        ("Python and go.", [(0, 6, "SKILL"), (11, 13, "SKILL")])]
