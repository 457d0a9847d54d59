import random
import re

import xxhash
from llm_rows import TEXTS
from pyspark.sql import functions as F

from tierwise.llm import simhash
from tierwise.llm.components import connected_components
from tierwise.llm.queries import op9_simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall("[^\x20\x09-\x0d]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(n):
    return n - 2**64 if n >= 2**63 else n


def test_fingerprints(odd_docs, docs, texts):
    got = {(r.doc_id, r.fingerprint) for r in simhash.fingerprints(odd_docs).collect()}
    assert got == {(i, signed(brute_fingerprint(t or ""))) for i, t in TEXTS}
    for r in simhash.fingerprints(docs).collect():
        assert r.fingerprint == signed(brute_fingerprint(texts[r.doc_id]))


def test_the_hash_is_the_engines(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert value == signed(xxhash.xxh64_intdigest(b"a b c", 42))


def test_links_against_brute_force(spark):
    rng, prints = random.Random(4), set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(12):
            flipped = centre
            for _ in range(rng.randint(0, 5)):
                flipped ^= 1 << rng.randrange(64)
            prints.add(flipped)
    prints |= {0, 1, 3, 2**64 - 1, 2**63, 2**32, 2**31}
    frame = spark.createDataFrame([(signed(p),) for p in prints for _ in range(2)], "fingerprint long")
    listed = sorted(prints)
    for bits in (0, 1, 2):
        got = [(r.u, r.v) for r in simhash.near_links(frame, bits).collect()]
        expected = {
            tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(listed) for b in listed[:i] if (a ^ b).bit_count() <= bits
        }
        assert set(got) == expected
        assert len(got) <= 2 * len(expected)


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(100, 300)] + [(1000, 1000 + i) for i in range(1, 200)]
    links += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    rng.shuffle(links)
    links += links[:20] + [(5, 5), (None, 7)]
    frame = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.root for r in connected_components(frame).collect()}
    true = [(a, b) for a, b in links if a is not None and a != b]
    assert got == roots({n for link in true for n in link}, true)
    assert connected_components(frame.limit(0)).count() == 0


def brute_components(rows):
    prints = {brute_fingerprint(t or "") for _, t in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    root, least = roots(prints, links), {}
    for i, t in rows:
        r = root[brute_fingerprint(t or "")]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(
        ((i, f"{brute_fingerprint(t or ''):016x}", least[root[brute_fingerprint(t or '')]]) for i, t in rows), key=str
    )


def test_near_duplicates(spark, odd_docs, no_docs, docs, texts):
    def found(frame):
        rows = simhash.near_duplicates(frame).select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"), "component_id")
        return sorted(map(tuple, rows.collect()), key=str)

    assert found(odd_docs) == brute_components(TEXTS)
    assert found(no_docs) == []
    expected = brute_components(list(texts.items()))
    assert found(docs) == expected
    assert sorted(map(tuple, op9_simhash(spark, "/root/testdata/sf0.001").collect()), key=str) == expected


def test_keep_one(odd_docs, no_docs, docs, texts):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert len(rows) == len({c for _, _, c in brute_components(TEXTS) if c is not None}) + 2  # two texts without an id
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [-5, 1, 2, 4, 5, 6, 7, 9]
    assert simhash.keep_one(no_docs).count() == 0
    components = {c for _, _, c in brute_components(list(texts.items()))}
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == components
