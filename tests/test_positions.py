"""Positions of JSON lines and cuts by a boundary key."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators import first_rows
from tallymark.sources import scan_jsonl_positions, split_bad_lines

SCHEMA = T.StructType([T.StructField("id", T.StringType())])


def written(folder, sizes):
    folder.mkdir()
    every = []
    for k, n in enumerate(sizes):
        lines = [json.dumps({"id": f"{k}-{i}", "more": "x" * (i * 37 % 300)}) for i in range(n)]
        (folder / f"part-{k:03}.jsonl").write_text("".join(line + "\n" for line in lines))
        every += [f"{k}-{i}" for i in range(n)]
    return every


@pytest.fixture
def small_splits(spark):
    for key, value in (("maxPartitionBytes", "2k"), ("openCostInBytes", "100")):
        spark.conf.set(f"spark.sql.files.{key}", value)
    yield
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def test_positions_follow_files_and_lines(spark, tmp_path, small_splits):
    every = written(tmp_path / "in", [150, 0, 1, 40, 3])
    found = scan_jsonl_positions(spark, str(tmp_path / "in"), SCHEMA)
    assert found.rdd.getNumPartitions() > 8
    assert sorted((r.position, r.id) for r in found.collect()) == list(enumerate(every))
    for count in (1, 128, 151, 194, 500, 0, None):
        some = scan_jsonl_positions(spark, str(tmp_path / "in"), SCHEMA, count)
        assert sorted((r.position, r.id) for r in some.collect()) == list(enumerate(every))[: count or None]
    with pytest.raises(ValueError):
        scan_jsonl_positions(spark, str(tmp_path / "in"), SCHEMA, -1)


def test_bad_lines_have_positions(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"id": "1"}\nnot json\n\n{"id": "2"}\n')
    found = scan_jsonl_positions(spark, str(tmp_path / "in"), SCHEMA, bad_lines="keep")
    assert sorted((r.position, r.id) for r in found.collect()) == [(0, "1"), (1, None), (2, None), (3, "2")]
    assert split_bad_lines(found)[0].count() == 2


def test_first_rows_move_no_rows(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.format_string("%04d", F.pmod(F.col("id") * 7, F.lit(1000)))).alias("k"), "id").repartition(9)
    for count in (1, 7, 128, 999, 1000, 1001):
        cut = first_rows(df, count, "k")
        assert sorted(r.k for r in cut.collect()) == [f"k{i:04}" for i in range(min(count, 1000))]
        assert "Join" not in cut._jdf.queryExecution().optimizedPlan().toString()
