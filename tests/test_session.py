import os

import pytest
from pyspark.sql import functions as F

from gridloom import session as ss
from gridloom.operators import regions
from tests.conftest import rows


def test_materialise_counts_rows_and_reads_back(spark):
    df = ss.materialise(spark.range(100).withColumn("v", F.col("id") * 2))
    assert ss.row_count(df) == 100
    assert df.agg(F.sum("v")).first()[0] == 9900
    assert spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]


def test_materialise_of_nothing(spark):
    df = ss.materialise(spark.range(0))
    assert ss.row_count(df) == 0 and df.count() == 0


NAN = float("nan")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_lookup_is_the_same_with_hot_keys(spark, monkeypatch, how, hot_rows):
    """Small and large right sides give the same rows, for hot keys, for NaN and for NULL."""
    left = spark.range(20_000).withColumn("k", F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 11 == 0, F.lit(NAN)).when(F.col("id") % 13 == 0, F.lit(None)).otherwise(F.col("id") % 500))
    left = left.withColumn("s", F.when(F.col("id") % 17 != 0, (F.col("id") % 2).cast("string")))
    right = spark.range(0, 490).select(F.col("id").cast("double").alias("k"), (F.col("id") * 10).alias("w"))
    right = right.unionByName(spark.createDataFrame([(NAN, -1), (None, -2)], "k DOUBLE, w LONG"))
    right = right.withColumn("s", F.explode(F.array(F.lit("0"), F.lit("1"), F.lit(None))))
    want = rows(ss.lookup(left, right, ["k", "s"], how, at_most=1))
    monkeypatch.setattr(ss, "HOT_ROWS", hot_rows)
    got = rows(ss.lookup(left, right, ["k", "s"], how, at_most=10**12))
    assert repr(got) == repr(want) and len(got) > 10_000
    keys = ss.materialise(left.select("k", "s"))
    assert repr(rows(ss.lookup(left, right, ["k", "s"], how, at_most=10**12, counted=keys))) == repr(want)
    assert how == "inner" or len(got) == 20_000


def test_lookup_of_three_keys(spark):
    left = spark.createDataFrame([(1.0,), (NAN,), (None,)], "k DOUBLE")
    right = spark.createDataFrame([(1.0, "a"), (NAN, "b")], "k DOUBLE, w STRING")
    for bound in (1, 10**12):
        assert sorted(repr(tuple(r)) for r in ss.lookup(left, right, ["k"], "left", bound).collect()) == ["(1.0, 'a')", "(None, None)", "(nan, 'b')"]


def stages(spark):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith("stage-")} if os.path.isdir(folder) else set()


def test_superseded_tables_are_deleted(spark):
    before = stages(spark)
    cells = spark.range(900).selectExpr("CAST(id DIV 30 AS INT) AS y", "CAST(id % 30 AS INT) AS x", "CAST((id * 7) % 5 < 3 AS INT) AS code")
    out = regions.label_regions(cells, 30)
    left = stages(spark) - before
    # What the result still reads: the cells, the contracted nodes and the components' roots.
    assert len(left) <= 3
    assert out.count() == 900
    one = ss.materialise(spark.range(3))
    two = ss.materialise(spark.range(3))
    ss.discard(one, spark.range(2))
    assert len(stages(spark) - before - left) == 1 and two.count() == 3


def test_global_rank_with_equal_values(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("v"))
    got = ss.global_rank(df, [F.desc("v"), F.asc("id")], "rank", partitions=7)
    want = sorted(((i % 3, i) for i in range(5000)), key=lambda t: (-t[0], t[1]))
    assert [(r["v"], r["id"]) for r in got.orderBy("rank").collect()] == want
    assert got.agg(F.max("rank")).first()[0] == 5000


def test_shared_folder_without_a_setting_is_in_the_warehouse():
    class Session:
        class conf:
            kept = {"spark.sql.warehouse.dir": "store://warehouse/"}

            @classmethod
            def get(cls, key, default=None):
                return cls.kept.get(key, default)

            @classmethod
            def set(cls, key, value):
                cls.kept[key] = value

    assert ss.shared_folder(Session()) == "store://warehouse/stages" == Session.conf.kept["spark.checkpoint.dir"]


@pytest.mark.parametrize("name", ["st2_concatenate", "jn1_area_weighted_regrid", "jb12_river_storage", "jb1_general_regrid"])
def test_monthly_fields_follow_the_rows(spark, monkeypatch, name):
    """A task holds a share of the groups that depends on the rows it was dealt, not on the session's number of partitions."""
    import __spark_entry__ as entry

    base = "/root/testdata/sf0.01"
    monkeypatch.setattr(ss, "TASK_ROWS", 1000, raising=False)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got = entry.queries()[name](spark, base).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert max(r["count"] for r in got) < sum(r["count"] for r in got) / 5


@pytest.mark.parametrize("name", ["jb4_c4_injection"])
def test_cells_of_a_fine_grid_are_dealt_out_by_their_number(spark, monkeypatch, name):
    """No shuffle of the fractions or of the fine grid ends in the session's few partitions, and coarse cells spread before they become fine ones."""
    import __spark_entry__ as entry
    from gridloom.operators import regrid
    from gridloom.sources import axes as ax

    monkeypatch.setattr(ss, "TASK_ROWS", 1000)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got = entry.queries()[name](spark, "/root/testdata/sf0.01").groupBy(F.spark_partition_id().alias("p")).count().collect()
        coarse = spark.range(36 * 72).selectExpr("CAST(id DIV 72 AS INT) AS y", "CAST(id % 72 AS INT) AS x", "id * 1D AS value").coalesce(1)
        fine = ax.regular_axis(spark, 180, -90.0, 1.0), ax.regular_axis(spark, 360, -180.0, 1.0)
        out = regrid.area_weighted(coarse, ax.regular_axis(spark, 36, -90.0, 5.0), ax.regular_axis(spark, 72, -180.0, 5.0), *fine)
        spread = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        wrong = out.filter("abs(value - ((y DIV 5) * 72 + x DIV 5)) > 1e-6").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert wrong == 0
    for sizes in ([r["count"] for r in got], [r["count"] for r in spread]):
        assert max(sizes) < sum(sizes) / 5
