"""The shipped example configurations run from the command line."""

import json
import os

from test_sample import MERGED, add_evening, bronze, deliver, loans_text  # noqa: F401

from tierwise.__main__ import main
from tierwise.streaming.merge import StreamedDimension

EXAMPLES = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples")


def localised(root, name):
    """An example with its data folder moved under ``root``."""
    with open(f"{EXAMPLES}/{name}", encoding="utf-8") as handle:
        text = handle.read().replace('"data/', f'"{root}/')
    path = root / name
    path.write_text(text)
    return str(path), json.loads(text)


def test_examples(spark, bronze):  # noqa: F811
    add_evening(bronze)
    path, load = localised(bronze, "initial_load.json")
    assert main(["initial-load", path]) == 0
    path, dimension = localised(bronze, "books_dimension.json")
    assert main(["dimension", path, "--quarantine", f"{bronze}/rejected"]) == 0
    gold = spark.read.parquet(load["gold_path"]).collect()
    assert dimension["target_table"] == load["gold_path"]
    assert {r.isbn: r.genre for r in gold} == MERGED
    path, report = localised(bronze, "lending_report.json")
    assert main(["report", path]) == 0
    assert spark.read.parquet(report["etl"]["output"]["path"]).count() == 3


def test_incremental_and_stream_take_turns(spark, bronze):  # noqa: F811
    path, cfg = localised(bronze, "incremental.json")
    silver = cfg["datasets"]["loans"]["output_path"]

    def loans():
        return sorted(r.loan_id for r in spark.read.parquet(silver).collect())

    assert main(["incremental", path, "--batch", "b1"]) == 0
    assert loans() == [11, 12, 13, 14, 15, 16]
    deliver(bronze, "loans_20240310120000.json", loans_text([(21, "b2", 9, "home")]))
    assert main(["stream", path]) == 0
    assert loans() == [11, 12, 13, 14, 15, 16, 21]
    deliver(bronze, "loans_20240310130000.json", loans_text([(22, "b2", 9, "home")]))
    assert main(["incremental", path]) == 0
    assert loans() == [11, 12, 13, 14, 15, 16, 21, 22]


def test_compact(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "k string, v int").write.parquet(f"{tmp_path}/base")
    dimension = StreamedDimension(spark, f"{tmp_path}/base", f"{tmp_path}/changes", ["k"])
    dimension.apply(spark.createDataFrame([("a", 2)], "k string, v int"), 0)
    path = tmp_path / "compact.json"
    path.write_text(json.dumps({"path": f"{tmp_path}/base", "changes": f"{tmp_path}/changes", "join_keys": "k"}))
    assert main(["compact", str(path)]) == 0
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/base").collect()] == [("a", 2)]
