"""Ids in ranges (S12), bad CSV lines (S2), retention of versions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from arrears.operators.sequence import row_number_in_ranges
from arrears.session import scratch_path
from arrears.sources import io


def test_row_number_in_ranges_equals_the_window(spark):
    day = dt.date(2024, 1, 1)
    rows = [(1, day, i) for i in range(4000)] + [(2, day + dt.timedelta(i % 5), i) for i in range(3000)]
    rows += [(100 + i % 900, day, i) for i in range(4000)] + [(None, day, i) for i in range(500)] + [(3, None, 1), (3, day, 2)]
    df = spark.createDataFrame(rows, "k long, d date, i long").repartition(7)
    got = row_number_in_ranges(df, "k", ["d", "i"], "n")
    assert got.columns == ["k", "d", "i", "n"]
    want = df.selectExpr("k", "d", "i", "cast(row_number() over (partition by k order by d, i) as bigint) as n")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_a_third_of_all_rows_on_one_day_is_spread(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
                                    F.lit(1).alias("d"), "id")
    per_range = df.repartitionByRange(8, "k", "d", "id").groupBy(F.spark_partition_id().alias("p")).count()
    assert per_range.agg(F.max("count")).first()[0] < 60_000 / 4
    got = row_number_in_ranges(df, "k", ["d", "id"], "n")
    hot = got.where("k = 7").agg(F.count("*"), F.countDistinct("n"), F.min("n"), F.max("n")).first()
    n = df.where("k = 7").count()
    assert tuple(hot) == (n, n, 1, n) and n >= 20_000


def test_row_number_in_ranges_of_nothing(spark):
    assert row_number_in_ranges(spark.createDataFrame([], "k long, i long"), "k", ["i"]).count() == 0


def _local(path):
    return path.removeprefix("file:")


def _lines(spark, *lines):
    path = _local(scratch_path(spark, "lines"))
    os.makedirs(path)
    with open(f"{path}/part.csv", "w") as f:
        f.write("\n".join(("id,day,amount", *lines)) + "\n")
    return path


def test_bad_lines_go_to_quarantine(spark):
    schema = spark.createDataFrame([], "id long, day date, amount decimal(10,2)").schema
    good = ["1,2024-01-02,3.50", "2,,", '3,2024-02-29,"4.00"']
    bad = ["x,2024-01-02,1.00", "4,2023-02-30,1.00", "5,2024-01-01", "6,2024-01-01,1.00,extra", "7,2024-01-01,1.2.3"]
    path, target = _lines(spark, *good, *bad), scratch_path(spark, "loaded")
    assert io.load_csv(spark, path, schema, target, max_bad=0.7) == {"lines": 8, "bad": 5}
    assert sorted(r["id"] for r in io.read_loaded(spark, target, schema).collect()) == [1, 2, 3]
    aside = io.read_quarantine(spark, target, schema).collect()
    assert sorted(r["line"] for r in aside) == sorted(bad) and all(r["file"].endswith("part.csv") for r in aside)
    with pytest.raises(Exception):                           # the plain read still stops at the first bad line
        io.read_csv(spark, path, schema).collect()


def test_error_budget_keeps_the_version_before(spark):
    schema = spark.createDataFrame([], "id long, day date, amount decimal(10,2)").schema
    target = scratch_path(spark, "loaded")
    assert io.load_csv(spark, _lines(spark, "1,2024-01-02,3.50"), schema, target) == {"lines": 1, "bad": 0}
    with pytest.raises(io.RefreshError):
        io.load_csv(spark, _lines(spark, "2,2024-01-02,3.50", "x,,"), schema, target, max_bad=0.4)
    assert [r["id"] for r in io.read_loaded(spark, target, schema).collect()] == [1]
    assert io.read_quarantine(spark, target, schema).count() == 0
    assert io.load_csv(spark, _lines(spark), schema, target) == {"lines": 0, "bad": 0}    # an empty file
    assert io.read_loaded(spark, target, schema).count() == 0


def test_retention_honours_readers(spark):
    target = scratch_path(spark, "versions")
    paths = [io.publish(spark, target, lambda p, i=i: spark.range(i + 1).write.parquet(p)) for i in range(2)]
    held = io.lease(spark, target, hours=1)
    assert held == paths[1]
    paths += [io.publish(spark, target, lambda p, i=i: spark.range(i + 1).write.parquet(p)) for i in range(2, 5)]
    assert io.retire(spark, target, keep=2) == sorted([paths[0], paths[2]])
    assert [r["path"] for r in io.published_versions(spark, target).collect()] == [paths[4], paths[3], paths[1]]
    assert spark.read.parquet(held).count() == 2 and io.published_path(spark, target) == paths[4]
    assert [os.path.exists(_local(p)) for p in paths] == [False, True, False, True, True]
    assert io.retire(spark, target, keep=2) == []
    with pytest.raises(ValueError):
        io.retire(spark, target, keep=0)
