import hashlib
from collections import Counter

import numpy as np
import pytest
from llm_rows import SF, TEXTS
from pyspark.sql import functions as F

from tierwise.llm import spotsigs
from tierwise.llm.queries import op4_spotsigs


def brute_chains(text, chain, distance):
    words = spotsigs.WORD.findall(text.lower())
    content = [(i, w) for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
    made = Counter()
    for i, w in enumerate(words):
        if w in spotsigs.ANCHORS:
            after = [c for j, c in content if j > i][: (chain - 1) * distance + 1 : distance]
            if len(after) == chain:
                made[(w, *after)] += 1
    return made


@pytest.mark.parametrize(("chain", "distance"), [(2, 1), (3, 2), (1, 1)])
def test_signatures_are_the_chains(texts, chain, distance):
    for text in list(texts.values())[:40]:
        chains = brute_chains(text, chain, distance)
        found = spotsigs.signatures(text, chain, distance)
        assert sorted(Counter(found.tolist()).values()) == sorted(chains.values()) if chains else len(found) == 1


def test_likeness_is_of_multisets(texts):
    some = list(texts.values())[:25]
    for a in some:
        for b in some:
            x, y = brute_chains(a, 2, 1), brute_chains(b, 2, 1)
            if x and y:
                true = (x & y).total() / (x | y).total()
                got = spotsigs.likeness(spotsigs.signatures(a), spotsigs.signatures(b))
                assert got == pytest.approx(true)
                assert spotsigs.likeness(spotsigs.signatures(a), spotsigs.signatures(b), 0.8) in (got, 0.0)
                assert got < 0.8 or spotsigs.likeness(spotsigs.signatures(a), spotsigs.signatures(b), 0.8) == got


def test_ranks_of_bounds(spark):
    for bounds in ([], [3], [1, 4, 9, 10, 11, 30, 31]):
        rows = spark.range(-2, 35).select("id", spotsigs.at_most(bounds, F.col("id")).alias("n")).collect()
        assert [r.n for r in rows] == [sum(b <= r.id for b in bounds) for r in rows]


def expected(given):
    order = sorted(((i, t or "") for i, t in given), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    made = []
    for n, (i, text) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other, after = map(spotsigs.signatures, (text, changed, following))
        made.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), spotsigs.as_text(own), spotsigs.as_text(other),
                     spotsigs.likeness(own, other), spotsigs.likeness(own, after)))
    return sorted(made, key=str)


def test_compare_with_next(spark, odd_docs, no_docs, texts):
    assert sorted(map(tuple, spotsigs.compare_with_next(odd_docs).collect()), key=str) == expected(TEXTS)
    assert spotsigs.compare_with_next(no_docs).count() == 0
    assert sorted(map(tuple, op4_spotsigs(spark, SF).collect()), key=str) == expected(list(texts.items()))
    one = spark.createDataFrame([(3, "The house of the rising sun")], "doc_id long, text string")
    assert spotsigs.compare_with_next(one).first().near_next == 1.0


def brute_classes(given):
    sets = {t or "": spotsigs.signatures(t or "") for _, t in given}
    key = {t: s.tobytes() for t, s in sets.items()}
    by_key = {key[t]: s for t, s in sets.items()}
    root = {k: k for k in by_key}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = Counter()
    keys = list(by_key)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and spotsigs.likeness(by_key[a], by_key[b]) >= 0.8:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for i, t in given:
        r = find(key[t or ""])
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(((i, least[find(key[t or ""])], links[key[t or ""]]) for i, t in given), key=str)


def test_near_duplicates(spark, odd_docs, no_docs, docs, texts):
    def found(frame):
        return sorted(map(tuple, spotsigs.near_duplicates(frame).collect()), key=str)

    assert found(docs) == brute_classes(list(texts.items()))
    assert found(odd_docs) == brute_classes(TEXTS)
    assert found(no_docs) == []
    assert np.isclose(spotsigs.likeness(*[spotsigs.signatures("the a of")] * 2), 1)
