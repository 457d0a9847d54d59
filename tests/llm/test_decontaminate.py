import hashlib
import random
import re

from llm_rows import SF, TEXTS

from tierwise.llm import decontaminate
from tierwise.llm.queries import op8_decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        found = words(text)
        n = min(window, len(found))
        for i in range(len(found) - n + 1 if n else 0):
            windows.setdefault(tuple(found[i : i + n]), set()).add(item)
    sizes, made = {len(w) for w in windows}, []
    for doc_id, text in docs:
        found, hit, named = words(text), set(), set()
        for n in sizes:
            for i in range(len(found) - n + 1):
                if (w := tuple(found[i : i + n])) in windows:
                    named |= windows[w] - {None}
                    hit |= set(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(map(str, named))).encode()).hexdigest()
        made.append((doc_id, len(found), len(hit), len(named), digest, bool(hit)))
    return sorted(made, key=str)


def found(docs, items, **how):
    return sorted(map(tuple, decontaminate.contamination(docs, items, **how).collect()), key=str)


def test_random_words(spark):
    rng = random.Random(2)
    text = lambda n, k: " ".join(rng.choice("abcdefgé"[:k]) for _ in range(n))
    items = [(i, text(rng.randint(0, 14), 3)) for i in range(40)] + [(7, text(12, 2)), (None, text(11, 2)), (50, None), (51, "A"), (52, "A")]
    docs = [(i, text(rng.randint(0, 60), rng.randint(2, 5))) for i in range(60)]
    docs += docs[:3] + [(None, text(30, 2)), (3, text(30, 2)), (70, None)]
    item_frame = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, shingle string, n int")
    doc_frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, row_key string")
    assert found(doc_frame, item_frame) == brute(docs, items)
    assert found(doc_frame, item_frame, window=4, shingle=2) == brute(docs, items, 4)
    kept = decontaminate.without_contaminated(doc_frame, item_frame)
    assert kept.columns == doc_frame.columns
    assert kept.count() == sum(not r[-1] for r in brute(docs, items))


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "Brown fox, and THE lazy dog of the old house!"), (2, "word5 of 5 the word6 of 6 the word7 of 7"), (3, "x y")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert found(odd_docs, frame) == brute(TEXTS, items)
    assert found(no_docs, frame) == []
    assert found(odd_docs, frame.limit(0)) == brute(TEXTS, [])
    assert decontaminate.without_contaminated(odd_docs, frame.limit(0)).count() == len(TEXTS)


def test_query(spark, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(map(tuple, op8_decontamination(spark, SF).collect()), key=str)
    assert got == brute(list(texts.items()), items)
    assert any(r[-1] for r in got)
