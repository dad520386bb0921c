"""CSV, JSON and receipt files: broken lines, whole files, order by time."""

import glob
import os
import time

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.plans import registry
from tidepool.sources import fixtures as X
from tidepool.sources import io as IO

SMALL = "/root/testdata/sf0.001"


def test_csv_header_and_broken_lines(spark, tmp_path):
    obs = X.observations(spark, SMALL).limit(20)
    good = tmp_path / "good"
    obs.coalesce(1).write.option("header", True).csv(str(good))
    (part,) = [f for f in good.iterdir() if f.suffix == ".csv"]
    lines = part.read_text().splitlines()
    lines[3] = lines[3].replace(lines[3].split(",")[7], "n/a", 1)
    lines[5] = "only,three,fields"
    part.write_text("\n".join(lines) + "\n")
    for crc in good.glob(".*.crc"):
        crc.unlink()
    got = IO.read_observations_csv(spark, str(good)).cache()
    assert got.count() == 20 and got.columns == [*S.OBSERVATION_COLUMNS, "broken_line"]
    assert {r.broken_line for r in got.where("broken_line is not null").collect()} == {lines[3], lines[5]}
    for header in (lines[0].replace("ph,", "acid,"), ",".join(reversed(lines[0].split(",")))):
        part.write_text("\n".join([header, *lines[1:]]) + "\n")
        with pytest.raises(ValueError):
            IO.read_observations_csv(spark, str(good))


def test_json_files_of_all_kinds(spark, tmp_path):
    kinds = {"a.json": '{"k": 1, "s": "x"}', "b.json": ' [{"k": 2}, {"k": 3, "other": true}]\n', "c.json": '{"k": 4', "d.json": "", "e.json": "[]", "f.json": "\n", "g.json": "no json"}
    for n, (name, text) in enumerate(kinds.items()):
        (tmp_path / name).write_text(text)
        os.utime(tmp_path / name, (time.time() - n * 60,) * 2)
    rows = IO.read_json_files(spark, str(tmp_path), "k int, s string").collect()
    assert [r.file_name for r in rows] == ["a.json", "b.json", "b.json", "c.json", "e.json", "f.json", "g.json"]  # Spark lists no file of zero bytes
    assert [(r.readable, r.record.k if r.record else None) for r in rows] == [(True, 1), (True, 2), (True, 3), (False, None), (True, None), (False, None), (False, None)]
    receipts = IO.read_receipts(spark, str(tmp_path), "k int, s string").collect()
    assert [r.k for r in receipts] == [1, 2, 3] and receipts[0].modified > receipts[1].modified


def test_newest_receipt_is_first_whatever_its_name(spark, tmp_path):
    for n, name in enumerate(("z.json", "m.json", "a.json")):
        (tmp_path / name).write_text('{"k": %d}' % n)
        os.utime(tmp_path / name, (1_700_000_000 + n,) * 2)
    assert [r.k for r in IO.read_receipts(spark, str(tmp_path), "k int").collect()] == [2, 1, 0]


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    one = IO.fingerprint(df).first()
    assert IO.fingerprint(df.orderBy(F.desc("k"))).first() == one
    assert IO.fingerprint(df.withColumn("s", F.lit("a"))).first() != one


def test_file_queries(spark):
    registry.load_all()
    csv = registry.QUERIES["scan_observations_csv"](spark, SMALL)
    assert {r.broken for r in csv.select("broken", "region").collect()} == {True, False}
    assert {r.readable for r in registry.QUERIES["scan_json_files"](spark, SMALL).select("readable").distinct().collect()} == {True, False}


def test_splits_are_paired_by_key_from_one_shuffle_of_targets(spark, monkeypatch):
    """Compressed tables, whose keys meet: each table's keys are shuffled once, and a row without a partner is not passed over."""
    registry.load_all()
    folders, written = [], IO.write_partitioned
    monkeypatch.setattr(IO, "write_partitioned", lambda df, path, by: folders.append(written(df, path, by)) or path)
    got = registry.QUERIES["write_splits"](spark, "/root/testdata/sf0.001")
    assert sum(r["rows"] for r in got.collect()) == 4 * spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert len(folders) == 4 and all(glob.glob(f"{f.removeprefix('file:')}/split=*/*.zstd.parquet") for f in folders)
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    keys = [line for line in plan if "Exchange hashpartitioning(obs_id" in line]
    # X and y of each task; y's other two uses are the same shuffle
    assert sum("ReusedExchange" not in line for line in keys) == 4 and sum("ReusedExchange" in line for line in keys) == 4

    def half(df, path, by):
        return written(df.where("crc32(obs_id) % 2 = 0") if "-y/" in path else df, path, by)

    monkeypatch.setattr(IO, "write_partitioned", half)
    with pytest.raises(SparkRuntimeException, match="no partner"):
        registry.QUERIES["write_splits"](spark, "/root/testdata/sf0.001").collect()
