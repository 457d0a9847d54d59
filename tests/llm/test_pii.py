import hashlib
import random
import re
import time

from llm_rows import SF, TEXTS

from tierwise.llm import pii
from tierwise.llm.queries import op1_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]


def test_base_spans():
    rng = random.Random(8)
    for _ in range(20_000):
        text = "".join(rng.choice("0123456789..@@ab-- +()é%") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    for run in ("9" * 200_000, "a" * 300_000 + "@", "1." * 100_000, "+1 " * 50_000, "a@" * 50_000, "1 " * 20_000):
        pii.all_spans(run, pii.trained())
    assert time.perf_counter() - start < 60


def test_held_out_lines():
    rng, right, wrong, missed = random.Random(77), 0, 0, 0
    for _ in range(300):
        text, spans = pii.training_line(rng)
        got = {s for zone in pii.zones(text) for s in pii.Lattice(text, zone).best(pii.trained())}
        right, wrong, missed = right + len(got & set(spans)), wrong + len(got - set(spans)), missed + len(set(spans) - got)
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97


def test_best_is_the_best_of_all_segmentations():
    text = "+1 (705) 555-5533 190.1.2.3 4111 1111"
    lattice, weights = pii.Lattice(text, pii.zones(text)[0]), pii.trained()
    top = lattice.scores(weights).max(axis=1)

    def best(at):
        if at == lattice.n:
            return 0.0
        ends = [(j, top[k]) for k, (i, j) in enumerate(lattice.segments) if i == at]
        return max([best(at + 1), *(s + best(j) for j, s in ends)])

    chosen = {s: k for k, s in enumerate(lattice.spans)}
    assert abs(sum(top[chosen[s[1:]]] for s in lattice.best(weights)) - best(0)) < 1e-9
    assert abs(lattice.expected(weights).sum(axis=1).max()) <= 1 + 1e-9


def test_numbers_side_by_side():
    text = "Call +1 (826) 555-4081 190.137.223.204 now"
    assert ("phone", 5, 22, False) in pii.all_spans(text, pii.trained())
    assert pii.masked(text, pii.all_spans(text, pii.trained())) == "Call [PHONE] [IP] now"


def test_clean_text_is_left_alone():
    for text in ("It was 2024-05-06 and 12:30.", "No. 123456 of 1,000 at 3.14", "x@y and @z", "4111 1111 1111 1112 is no card"):
        assert pii.all_spans(text, pii.trained()) == []


def check(rows, given):
    assert len(rows) == len(given)
    by_row = sorted((str(i), t or "") for i, t in given)
    for r, (i, text) in zip(sorted(rows, key=lambda r: (str(r.doc_id), r.base_sha256)), sorted(by_row, key=lambda x: (x[0], digest(x[1]))), strict=True):
        base = brute(text)
        assert str(r.doc_id) == i and r.base_sha256 == digest(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in PATTERNS]
        spans = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert {(k, int(a), int(b)) for k, a, b in spans} >= set(base)
        assert len(spans) == len(base) + r.n_added
        assert spans == sorted(spans, key=lambda s: (list(PATTERNS).index(s[0]), int(s[1]), int(s[2])))


def digest(text):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in brute(text)).encode()).hexdigest()


def test_query(spark, odd_docs, no_docs, texts):
    check(op1_pii(spark, SF).collect(), list(texts.items()))
    check(pii.digests(pii.find(odd_docs)).collect(), TEXTS)
    assert pii.digests(pii.find(no_docs)).count() == 0


def test_redact(odd_docs, no_docs):
    rows = pii.redact(odd_docs, length_col="n_chars").collect()
    assert sorted(r.text for r in rows if r.doc_id == 9) == ["mail [EMAIL], call [PHONE] [IP] or [CARD]!"]
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    assert sorted(str(r.text) for r in rows if r.doc_id != 9) == sorted(str(t) for i, t in TEXTS if i != 9)
    assert pii.redact(no_docs).columns == odd_docs.columns and pii.redact(no_docs).count() == 0
