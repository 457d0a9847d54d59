import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, mismatch
from llm_rows import SF, TEXTS

from tierwise.llm import ranking
from tierwise.llm.queries import ORACLE, QUERIES

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, key string, rank int"


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    big_n = sum(bool(c) for _, c in counted)
    big_l = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    made = []
    for item, text in items:
        scored = []
        for doc_id, found in counted:
            score = 0
            for t in terms(text):
                if found[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * sum(found.values()) * big_n) // big_l
                    score += w * ((1000000000 * found[t]) // (1000 * found[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        made += [(item, at, None if no_id else i, -s) for at, (s, no_id, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(made, key=str)


def rows(frame):
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, frame.collect()), key=str)


def test_random_items(spark):
    rng = random.Random(5)
    text = lambda n, words: " ".join(rng.choice(words) for _ in range(n))
    words = [f"w{i % 13}{'é' * (i % 3)}" for i in range(60)] + ["The", "the", "of", "OF"] * 20
    docs = [(i, text(rng.randint(0, 50), words)) for i in range(300)]
    docs += docs[:4] + [(None, text(30, words)), (None, None), (3, "the of")] + [(900 + i, "w1 the same text") for i in range(40)]
    items = [(i, text(rng.randint(0, 30), words)) for i in range(40)] + [(1, "the the of"), (None, "w1"), (70, None), (71, "unheard"), (72, "the of w1 w2é"), (73, "the of w1 w2é")]
    doc_frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, terms string, n int").repartition(7)
    item_frame = spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS)
    assert rows(ranking.rank(doc_frame, item_frame)) == brute(docs, items)
    assert rows(ranking.rank(doc_frame, item_frame, k=3, block_terms=50)) == brute(docs, items, 3)


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "The quick fox; the house"), (2, "word5 of 5 the word6"), (3, "漢字 12½ é text"), (4, "")]
    frame = spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS)
    assert rows(ranking.rank(odd_docs, frame)) == brute(TEXTS, items)
    assert rows(ranking.rank(no_docs, frame)) == []
    assert rows(ranking.rank(odd_docs, frame.limit(0))) == []


def test_graph_gives_the_plain_sums():
    rng = random.Random(8)
    shared = [rng.sample(range(80), 9) for _ in range(6)]
    items = []
    for key in range(60):
        chosen = {t for part in rng.sample(shared, rng.randint(0, 3)) for t in part} | set(rng.sample(range(80), rng.randint(0, 4)))
        items.append((key, {t: rng.choice([1, 1, 1, 2]) for t in chosen}))
    graph = ranking.mined(items)
    by_term = np.array([[rng.randrange(1000) for _ in range(5)] for _ in range(80)])
    expected = {key: sum(n * by_term[t] for t, n in times.items()) for key, times in items if times}
    assert graph.keys == list(expected)
    assert (graph.scores(by_term) == np.array(list(expected.values()))).all()
    plain = sum(len(times) for _, times in items)
    assert sum(len(a) for a, _ in graph.levels) + len(graph.lists) < 0.75 * plain


def test_items_that_are_equal_share_everything():
    graph = ranking.mined([(i, {t: 1 for t in range(32)}) for i in range(4)])
    assert len(graph.lists) == 4 and len(set(graph.lists.tolist())) == 1 and len(graph.levels) == 5


@pytest.mark.parametrize("name", ["op12_ranking", "op13_exact_dedup"])
def test_query_matches_sql(spark, name):
    assert mismatch(spark, connect(SF), name, QUERIES[name], ORACLE[name], SF) is None
