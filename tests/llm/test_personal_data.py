import hashlib
import random
import re

import pytest
from fixtures import documents, nothing, rows, texts

from hirelens.llm import personal_data as pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    d = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def brute(text):
    return [(m.start(), i, m.end()) for i, (kind, pattern) in enumerate(PATTERNS.items())
            for m in re.finditer(pattern, text or "") if passes(kind, m[0])]


def noise(seed, n):
    rng = random.Random(seed)
    atoms = ["a@b.co", "x.y%z@q-r.s-t.uv", "@", ".", "a@b", "1.2.3.4", "999.1.1.1", "0001.2.3.255", "1.2.3.4.5.6.7.8", "4539 1488 0343 6467",
             "4539148803436467", "79927398713", "0", "-", " ", "+", "+1 (136) 555-7479", "+49 30 1234567", "(", ")", "x", "é", "漢", "12-34", "\n",
             "+1", "@c.d", "..", "00000000000000", "a@b.c.@d.e", "+" + "1" * 16, "tel ", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5"]
    return "".join(rng.choices(atoms, k=n))


@pytest.mark.parametrize("seed", range(200))
def test_base_matches(seed):
    text = noise(seed, 1 + seed % 30)
    found = [(c.start, c.kind, c.end) for c in pii.candidates(text) if c.base]
    assert sorted(found) == sorted(brute(text)), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " + " " * 300_000, "a@" * 100_000, "1 " * 150_000, "(at) " * 50_000):
        pii.candidates(text)


def test_find(spark):
    some = texts() + [noise(s, 40) for s in range(30)] + ["write to joe [at] mail [dot] com now"]
    found = pii.find(documents(spark, some)).collect()
    assert len(found) == len(rows(some))
    by_text = {r[0]: r[1] for r in rows(some)}
    for r in found:
        if r.doc_id is None:
            continue
        spans = sorted(brute(by_text[r.doc_id]))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        told = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(r.spans.split(","))


def test_labelers_are_weighed_by_what_they_agree_on():
    """Loose phone numbers that look like known ones are added; those that speak against it are not."""
    code = lambda text, s, e, base: pii.votes(3, text, s, e, base, True)
    sure, loose, bad = "tel +1 206 555 0100 x", "tel 206-555-0100 x", "order 106-555-0100x"
    counts = [(3, code(sure, 4, 19, True), True, 500), (3, code(loose, 4, 16, False), False, 40),
              (3, code(bad, 6, 18, False), False, 30), (3, pii.votes(3, "order +1 2", 6, 10, False, False), False, 400)]
    accepted = pii.learn(counts)
    assert (3, counts[1][1]) in accepted and (3, counts[2][1]) not in accepted and (3, counts[3][1]) not in accepted


def test_mask(spark):
    some = ["mail a@b.com, ip 1.2.3.4!", None, "", "clean text"] + [noise(s, 30) for s in range(10)]
    docs = spark.createDataFrame([(i, t, len(t or ""), "extra") for i, t in enumerate(some)], "doc_id long, text string, n_chars long, found string")
    masked = {r.doc_id: r for r in pii.mask(docs).collect()}
    assert masked[0].text == "mail [EMAIL], ip [IP]!" and masked[0].n_chars == len(masked[0].text)
    assert masked[1].text is None and masked[2].text == "" and masked[3].text == "clean text" and masked[3].found == "extra"
    for i, t in enumerate(some):
        joined = []
        for start, _, end in sorted(brute(t)):
            if joined and start < joined[-1][1]:
                joined[-1][1] = max(end, joined[-1][1])
            else:
                joined.append([start, end])
        marks = re.findall(r"\[(?:EMAIL|IP|CARD|PHONE)\]", masked[i].text or "")
        assert len(marks) >= len(joined) and not any(t[a:b] in masked[i].text for a, b in joined if b - a > 12 and t.count(t[a:b]) == 1)


def test_nothing(spark):
    assert pii.find(nothing(spark)).count() == 0 and pii.mask(nothing(spark)).count() == 0
