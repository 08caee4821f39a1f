"""Session helpers: lineage cuts, size-checked broadcasts, skew-proof lookups and a distributed global ranking."""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: A side is broadcast only when it has at most this many rows (rows here are a handful of numbers wide).
BROADCAST_ROWS = 500_000
#: A key is hot when it has more than HOT_ROWS rows and more than 1/HOT_SHARE of the rows of such keys, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE, HOT_ROWS = 1000, 10_000
#: Rows that one task gets when groups are dealt out that hardly shrink by being aggregated.
TASK_ROWS = 250_000


def get_session(app: str = "gridloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder lineage cuts are written to: `spark.checkpoint.dir`, and where it is unset a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/stages"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_ROWS: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write `df` as a table in the shared folder and read it back.

    The rows are counted while they are written, so later size and emptiness checks cost nothing.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _ROWS[out] = seen.get.get("rows", 0)
    _PATHS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing reads any more; others are passed over."""
    for table in tables:
        path = _PATHS.pop(table, None)
        if path:
            context = table.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def row_count(table: DataFrame) -> int:
    """Rows of a materialised table."""
    if table not in _ROWS:
        _ROWS[table] = table.count()
    return _ROWS[table]


def is_small(df: DataFrame, rows: int | None = None) -> bool:
    rows = BROADCAST_ROWS if rows is None else rows
    return _ROWS[df] <= rows if df in _ROWS else df.limit(rows + 1).count() <= rows


def small(df: DataFrame, at_most: int | None = None, rows: int | None = None) -> DataFrame:
    """`df` with a broadcast hint if it is proven small, otherwise to be merged.

    The proof is `at_most`, a bound on its rows known beforehand, or else a count.
    """
    proven = at_most <= (BROADCAST_ROWS if rows is None else rows) if at_most is not None else is_small(df, rows)
    return F.broadcast(df) if proven else merged(df)


def merged(df: DataFrame) -> DataFrame:
    """`df`, a side of a join that grows with the input, to be shuffled and merged.

    Spark judges a table by its size on disk, where it is compressed, and knows nothing of rows that are exploded afterwards: left to itself it
    would broadcast many times what it takes for small, by way of the driver.
    """
    return df.hint("merge")


def deal(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """`df` of about `rows` rows dealt out by `keys`, which have few rows each, to as many tasks as hold `TASK_ROWS` rows apiece.

    Aggregates by these and further keys then run where the rows lie, and what a task holds does not follow the size of the input.
    """
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS)), *keys)


def within_tasks(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """`df` as `deal` gives it out if the session's shuffle partitions would hold more than `TASK_ROWS` of its `rows` each, otherwise unchanged.

    Joins and aggregates by the same keys follow the number of tasks dealt to.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return deal(df, rows, *keys) if rows > parts * TASK_ROWS else df


def lookup(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", at_most: int | None = None,
           counted: DataFrame | None = None) -> DataFrame:
    """Equi-join of `left` with `right`, whose rows are unique in `on`, safe for hot keys on the left.

    A right side proven small, by the bound `at_most` or by a count, is broadcast.  Otherwise both are shuffled, and keys with more than
    HOT_ROWS left rows that hold more than 1/HOT_SHARE of the rows of such keys (so there are fewer than HOT_SHARE) are salted: their left
    rows go to several tasks, their right rows to each of these.  Both ways give the same rows: NaN equals NaN and NULL matches nothing.
    The left side is computed twice for that, once to count its keys, unless `counted` is a table at hand with as many rows per key.
    """
    if at_most <= BROADCAST_ROWS if at_most is not None else is_small(right):
        return left.join(F.broadcast(right), on, how)
    often = materialise((left if counted is None else counted).dropna(subset=[c for c, t in left.dtypes if c in on and t not in ("float", "double")])
                        .groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_ROWS))
    total = often.agg(F.sum("_n")).first()[0] if row_count(often) else 0
    salts = F.least(F.ceil(F.col("_n") / HOT_ROWS), F.lit(HOT_SHARE)).cast("int")
    hot = F.broadcast(often.filter(F.col("_n") > total / HOT_SHARE).select(*on, salts.alias("_salts")))
    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(c).isNull()
    # Rows without a key match nothing; they are spread, so that they cannot pile up in one task.
    spread = F.when(missing, F.lit(HOT_SHARE)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = left.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), spread).cast("int")).drop("_salts")
    copies = right.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return salted.join(merged(copies), [*on, "_salt"], how).drop("_salt")


def attach(df: DataFrame, by: list[str], *aggs: Column) -> DataFrame:
    """Group aggregates on every row, by a partial aggregation and a lookup: a huge group stays spread over tasks."""
    return lookup(df, df.groupBy(*by).agg(*aggs), by)


def rank_within(df: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """1-based position of each row in its group, without a task having to hold a whole group."""
    ranked = materialise(global_rank(df, [F.asc(c) for c in by] + order, name))
    return attach(ranked, by, F.min(name).alias("_start")).withColumn(name, (F.col(name) - F.col("_start") + 1).cast("int")).drop("_start")


def global_rank(df: DataFrame, order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """Add `name`, the 1-based position of each row in the total order `order`, without one task seeing all rows.

    Rows are range partitioned, ranked inside their partition, and shifted by the number of rows in the partitions
    before.  `order` must end in a unique key: equal leading values are then still spread over partitions.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = materialise(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    sizes = sorted((r["_part"], r["n"]) for r in part.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    start, rows = 0, []
    for pid, count in sizes:
        rows.append((pid, start))
        start += count
    offsets = spark.createDataFrame(rows, "_part INT, _start LONG")
    ranked = part.withColumn("_pos", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return (
        ranked.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos"))
        .drop("_part", "_start", "_pos")
    )
