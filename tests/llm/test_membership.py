import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwise.llm import decontaminate, quality, simhash
from tierwise.llm.common import free_name, row_key
from tierwise.llm.membership import filter_of, parted, passing, without_keys


def test_filter_has_its_keys_and_few_others(spark):
    rng = random.Random(3)
    for n in (0, 1, 3000, 20_000):
        keys = [rng.getrandbits(64) for _ in range(n)]
        others = [rng.getrandbits(64) for _ in range(50_000)]
        frame = spark.createDataFrame([(k - (1 << 63),) for k in keys], "hash long")
        signed = np.array([k - (1 << 63) for k in keys], dtype=np.int64).view(np.uint64)
        cells = filter_of(frame)
        assert len(passing(cells, signed)) == n
        assert len(passing(cells, np.array(others, dtype=np.uint64))) <= 0.03 * len(others)


def rows(spark):
    data = [(i, f"text {i}", "x", i % 7) for i in range(400)] + [(5, "text 5", "x", 5)] * 3 + [(None, None, None, None)] * 2
    return spark.createDataFrame(data, "doc_id long, text string, row_key string, _row_key int")


def test_rows_go_and_stay(spark):
    docs = rows(spark)
    assert free_name(docs, "row_key") == "__row_key" and free_name(docs, "Text") == "Text"
    gone = docs.filter("doc_id % 10 = 3").select(row_key().alias("row_key"))
    single = docs.filter("doc_id = 5 OR doc_id IS NULL").select(row_key().alias("row_key"))
    left = without_keys(docs, row_key(), gone, single)
    assert left.schema == docs.schema
    found = left.collect()
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == [i for i in range(400) if i % 10 != 3]
    assert sum(r.doc_id is None for r in found) == 1
    assert without_keys(docs, row_key(), gone).count() == docs.count() - 40
    assert without_keys(docs.limit(0), row_key(), gone, single).count() == 0
    assert without_keys(docs, row_key(), gone.limit(0)).count() == docs.count()


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_kept_texts_pass_no_exchange(spark, docs, threshold):
    """Of the two parts one has the kept rows, and nothing in its plan moves them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        gone = docs.filter("doc_id % 20 = 0").select(row_key().alias("row_key"))
        others, doubtful, _ = parted(docs, row_key(), gone)
        assert "Exchange" not in others._jdf.queryExecution().executedPlan().toString()
        assert others.count() + doubtful.count() == docs.count()
        assert doubtful.count() <= gone.count() + 0.03 * docs.count()
        left = without_keys(docs, row_key(), gone)
        assert left._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
        assert left.count() == docs.count() - gone.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_columns_of_helper_names_stay(spark, docs):
    """Columns called as the stages' own helpers are kept with their values."""
    names = ["row_key", "__row_key", "_row_key", "log_weight", "__log_weight", "ROW_KEY2", "stays", "fingerprint"]
    given = docs.withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in names})
    items = spark.createDataFrame([(1, "no such words here")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    _, sample = quality.resample(given, labels, F.col("quality") == 1, F.col("quality") == 0)
    for kept in (simhash.keep_one(given), decontaminate.without_contaminated(given, items), sample.keeps(given)):
        assert kept.columns == given.columns
        for r in kept.collect():
            assert all(r[c] == f"{c} {r.doc_id}" for c in names)
