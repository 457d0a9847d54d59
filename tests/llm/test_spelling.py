import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from llm_rows import SF, TEXTS

from tierwise.llm import spelling
from tierwise.llm.queries import op11_spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(docs, length=7, count=2):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= count and len(w) >= length}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for d in (-1, 0, 1) for v in by_length.get(len(w) + d, []) if one_apart(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()), key=str)


def rows(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, frame.collect()), key=str)


def test_query_against_brute_force(spark, texts):
    expected = brute(brute_words(texts.items()))
    assert rows(op11_spelling(spark, SF)) == expected
    assert any(f for _, f, *_ in expected)


def test_odd_rows(spark, odd_docs, no_docs):
    assert rows(spelling.variants(odd_docs, least_count=1)) == brute(brute_words(TEXTS, count=1))
    assert rows(spelling.variants(no_docs)) == []
    with pytest.raises(ValueError, match="more frequent"):
        spelling.variants(no_docs, ratio=1)


def test_near_words_of_few_letters(spark):
    rng = random.Random(6)
    words = {"".join(rng.choices("abé", k=rng.randint(7, 9))) for _ in range(700)} | {"a" * n for n in range(7, 12)} | {"ab" * n for n in range(4, 9)}
    words = {w: rng.randint(2, 50) for w in words}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [tuple(r) for r in spelling.near_words(frame).collect()]
    expected = {(a, b, words[b]) for a in words for b in words if one_apart(a, b)}
    assert len(got) == len(set(got)) and set(got) == expected


def test_chains_of_forms(spark):
    words = [("abcdefgh", 2), ("abcdefghi", 20), ("abcdefghij", 200), ("abcdefghijk", 2000), ("abcdefghijkl", 20000), ("abcdefgx", 1999)]
    docs = []
    for word, n in words:
        for i in itertools.count():
            if n == 0:
                break
            if zlib.crc32(f"{i}:{word}".encode()) % 31:
                k = min(n, 500)
                docs.append((i, " ".join([word.upper()] * k)))
                n -= k
    got = rows(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute(dict(words))
    assert {r[2] for r in got} == {"abcdefghijkl", "abcdefgx"}


def test_pivots_against_all_choices():
    rng = random.Random(7)
    for _ in range(2000):
        ranks = rng.choices(range(6), k=rng.randint(3, 12))
        places = spelling.prefix_of(ranks)
        assert len(places) >= 3 and all((ranks[at] <= max(ranks[i] for i in places)) == (at in places) for at in range(len(ranks)))
        costs = [rng.randrange(10) for _ in places]
        chosen = spelling.pivots_of(places, costs)
        cost = dict(zip(places, costs, strict=True))
        best = min(cost[a] + cost[b] for a in places for b in places if a + 2 <= b)
        assert len(chosen) == 2 and chosen[0] + 2 <= chosen[1] and cost[chosen[0]] + cost[chosen[1]] == best
