"""Time axes: year ranges, climatologies, bounds, intervals, padding.  All per field, so many fields go through at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import attach, lookup, materialise


def year_range(cells: DataFrame, begin: int, end: int, year: str = "year", by: list[str] | None = None, strict: bool = True) -> DataFrame:
    """Rows of the years begin..end, both included.  No data at all raises, as does a field that covers only a part."""
    out = cells.filter(F.col(year).between(begin, end))
    if strict:
        lo_hi = [F.min(year).alias("lo"), F.max(year).alias("hi")]
        if by:
            worst = cells.groupBy(*by).agg(*lo_hi).agg(F.max("lo").alias("lo"), F.min("hi").alias("hi")).first()
        else:
            worst = cells.agg(*lo_hi).first()
        if worst["lo"] is None or worst["lo"] > end or worst["hi"] < begin:
            raise ValueError(f"no data between {begin} and {end}")
        if worst["lo"] > begin or worst["hi"] < end:
            raise ValueError(f"data cover {worst['lo']} to {worst['hi']}, not all of {begin} to {end}")
    return out


def split_climatologies(cells: DataFrame, climatology: bool, field: str = "field_id", t: str = "t") -> DataFrame:
    """Fields with exactly 12 times, or all the others."""
    n = cells.groupBy(field).agg(F.countDistinct(t).alias("_n"))
    keep = n.filter(F.col("_n") == 12 if climatology else F.col("_n") != 12).select(field)
    # A few fields may hold all cells, so the list of fields is looked up, not shuffled to.
    return lookup(cells.filter(F.col(field).isNotNull()), keep.filter(F.col(field).isNotNull()), [field]).select(*cells.columns)


def month_bounds(year: Column, month: Column) -> Column:
    """struct(point, lo, hi) of a monthly mean: bounds on the first of the months, the point half way."""
    lo = F.make_date(year, month, F.lit(1)).cast("timestamp_ntz")
    hi = F.add_months(F.make_date(year, month, F.lit(1)), 1).cast("timestamp_ntz")
    days = F.datediff(hi, lo)
    point = lo + F.make_dt_interval(F.lit(0), (days * 12).cast("int"))
    return F.struct(point.alias("point"), lo.alias("lo"), hi.alias("hi"))


def guess_month_bounds(times: DataFrame, t: str = "point", strict: bool = True) -> DataFrame:
    """Bounds of monthly times from the calendar; a time that is not the middle of its month raises."""
    b = month_bounds(F.year(t), F.month(t))
    out = times.withColumn("_b", b)
    if strict and out.filter(F.col("_b.point") != F.col(t)).limit(1).count():
        raise ValueError("a time is not the middle of its month")
    return out.withColumn("lo", F.col("_b.lo")).withColumn("hi", F.col("_b.hi")).drop("_b")


def midpoints(series: DataFrame, key: list[str], t: str = "t", value: str = "value") -> DataFrame:
    """Year-start values from mid-year ones: the mean of consecutive values; the last is carried on by half a step."""
    w = Window.partitionBy(*key).orderBy(t)
    nxt, prev = F.lead(value).over(w), F.lag(value).over(w)
    v = F.col(value)
    return series.withColumn(value, F.coalesce(0.5 * (v + nxt), v + 0.5 * (v - prev), v))


def year_starts(series: DataFrame, key: list[str], begin: int, end: int, year: str = "year", value: str = "value") -> DataFrame:
    """Values at the start of the years begin..end from yearly means, mid-year in source years.

    The start of year y is the mean of y-1 and y.  The first year the source has no predecessor for takes its own mean;
    the year after the last source year is carried on by half the last step.
    """
    w = Window.partitionBy(*key).orderBy(year)
    near = series.withColumn("_prev", F.lag(value).over(w)).withColumn("_last", F.lead(year).over(w).isNull())
    prev, v, y = F.col("_prev"), F.col(value), F.col(year)
    own = F.struct(y.alias("y"), F.coalesce(0.5 * (prev + v), v).alias("v"))
    after = F.struct((y + 1).alias("y"), F.coalesce(v + 0.5 * (v - prev), v).alias("v"))
    out = near.withColumn("_p", F.explode(F.when(F.col("_last"), F.array(own, after)).otherwise(F.array(own))))
    return out.select(*key, F.col("_p.y").alias(year), F.col("_p.v").alias(value)).filter(F.col(year).between(begin, end))


def last_years(series: DataFrame, key: list[str], n: int, t: str = "t") -> DataFrame:
    """The last n times per series."""
    w = Window.partitionBy(*key).orderBy(F.desc(t))
    return series.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def interval(times: DataFrame, by: list[str], point: str = "point") -> DataFrame:
    """Step of each time axis: 'annual', 'monthly', whole days or whole hours, else NULL; axes need two points.

    Times are timestamps; the calendar's own lengths decide, so months of 28 to 31 days are one month each.
    """
    w = Window.partitionBy(*by).orderBy(point)
    nxt = F.lead(point).over(w)
    p = F.col(point)
    months = (F.year(nxt) - F.year(p)) * 12 + F.month(nxt) - F.month(p)
    same = (F.dayofmonth(nxt) == F.dayofmonth(p)) & (F.date_format(nxt, "HH:mm:ss") == F.date_format(p, "HH:mm:ss"))
    seconds = F.unix_timestamp(nxt.cast("timestamp")) - F.unix_timestamp(p.cast("timestamp"))
    d = times.select(*by, nxt.alias("_n"), F.when(same, months).otherwise(-1).alias("_m"), seconds.alias("_s")).filter("_n IS NOT NULL")
    per = d.groupBy(*by).agg(
        F.min("_m").alias("m0"), F.max("_m").alias("m1"), F.min("_s").alias("s0"), F.max("_s").alias("s1"), F.count(F.lit(1)).alias("steps")
    )
    regular = F.col("s0") == F.col("s1")
    kind = (
        F.when((F.col("m0") == 12) & (F.col("m1") == 12), "annual")
        .when((F.col("m0") == 1) & (F.col("m1") == 1), "monthly")
        .when(regular & (F.col("s0") % 86400 == 0), F.concat((F.col("s0") / 86400).cast("int").cast("string"), F.lit(" days")))
        .when(regular & (F.col("s0") % 3600 == 0), F.concat((F.col("s0") / 3600).cast("int").cast("string"), F.lit(" hours")))
    )
    return per.select(*by, "steps", kind.alias("interval"))


def periodic(times: DataFrame, by: list[str]) -> DataFrame:
    """Is the end of each axis ``(lo, hi)`` exactly one year after its start, with more than one time?"""
    per = times.groupBy(*by).agg(F.min("lo").alias("first"), F.max("hi").alias("last"), F.count(F.lit(1)).alias("n"))
    year_on = (F.year("last") == F.year("first") + 1) & (F.date_format("last", "MM-dd HH:mm") == F.date_format("first", "MM-dd HH:mm"))
    return per.withColumn("periodic", (F.col("n") > 1) & year_on)


def time_header(times: DataFrame, by: list[str]) -> DataFrame:
    """Header facts per field: kind (single, series, periodic), first and last time, interval."""
    ends = times.groupBy(*by).agg(F.min("point").alias("t1"), F.max("point").alias("t2"))
    p = periodic(times, by).select(*by, "n", "periodic")
    i = interval(times, by).select(*by, "interval")
    kind = F.when(F.col("periodic"), 2).when(F.col("n") > 1, 1).otherwise(0)
    return ends.join(p, by).join(i, by, "left").select(*by, kind.alias("time_type"), "n", "t1", "t2", "interval")


def contiguous_bounds(records: DataFrame, by: list[str], lo: str = "lo", hi: str = "hi", final: Column | None = None) -> DataFrame:
    """Upper bound of each time = lower bound of the next; the last = `final` or one year after the first."""
    t = records.select(*by, lo).distinct()
    w = Window.partitionBy(*by).orderBy(lo)
    first = F.min(lo).over(Window.partitionBy(*by))
    end = final if final is not None else F.add_months(first, 12)
    nxt = t.withColumn("_hi", F.coalesce(F.lead(lo).over(w).cast("timestamp"), end.cast("timestamp")))
    return lookup(records, nxt, by + [lo]).withColumn(hi, F.col("_hi")).drop("_hi")


def equal_counts(records: DataFrame, by: list[str], time: list[str]) -> DataFrame:
    """Does every time of a file have the same number of records?"""
    n = records.groupBy(*by, *time).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*by).agg(F.count(F.lit(1)).alias("times"), (F.min("n") == F.max("n")).alias("equal"))


def pad_ends(
    cells: DataFrame, key: list[str], first_year: int, last_year: int, copy_first: int, copy_last: int,
    year: str = "year", month: str = "month", repeat_last: int = 1,
) -> DataFrame:
    """Add year `first_year` as a copy of `copy_first` and `repeat_last` years up to `last_year` as copies of `copy_last`.

    Afterwards times are numbered as 30-day months per field, at mid-month.
    """
    tail = list(range(last_year - repeat_last + 1, last_year + 1))
    y = F.col(year)
    # One scan: every row says in which years it appears.
    years = F.array(F.when(~y.isin([first_year, *tail]), y), F.when(y == copy_first, F.lit(first_year)), *[F.when(y == copy_last, F.lit(t)) for t in tail])
    out = materialise(cells.withColumn(year, F.explode(F.array_compact(years))))
    steps = out.select(*key, year, month).distinct()
    n = F.row_number().over(Window.partitionBy(*key).orderBy(year, month)) - 1
    return lookup(out, steps.withColumn("days", n * 30 + 15), key + [year, month])


def climatology_records(records: DataFrame, year: int, by: list[str]) -> DataFrame:
    """Record times as months of one climatological year: from the first to the next first, December into next year.

    The calendar is Gregorian (1) if any day in the file exceeds 30, else 360 days (2).
    """
    december = F.col("mon") == 12
    return (
        attach(records, by, F.max(F.greatest("dat", "datd")).alias("_top"))
        .withColumn("tim", F.lit(20) + F.when(F.col("_top") > 30, 1).otherwise(2)).drop("_top")
        .withColumn("dat", F.lit(1)).withColumn("datd", F.lit(1))
        .withColumn("yr", F.lit(year)).withColumn("yrd", F.when(december, year + 1).otherwise(year))
        .withColumn("mond", F.when(december, 1).otherwise(F.col("mon") + 1))
    )


def shift_reference_year(records: DataFrame, by: list[str], year: int = 4) -> DataFrame:
    """Shift all years of a file so that its first one is `year`."""
    if year <= 0:
        raise ValueError("the reference year must be positive")
    return attach(records, by, (F.lit(year) - F.min("yr")).alias("_o")).withColumn("yr", F.col("yr") + F.col("_o")).withColumn("yrd", F.col("yrd") + F.col("_o")).drop("_o")


def as_monthly_means(records: DataFrame, year: int = 1950) -> DataFrame:
    """Rewrite instantaneous monthly records as monthly means of one year; records that need none are unchanged."""
    need = (F.col("datd") == 0) & (F.expr("tim DIV 10 % 10") == 0)
    december = F.col("mond") >= 12
    return (
        records.withColumn("_n", need)
        .withColumn("tim", F.when(F.col("_n"), 22).otherwise(F.col("tim")))
        .withColumn("datd", F.when(F.col("_n"), 1).otherwise(F.col("datd")))
        .withColumn("yr", F.when(F.col("_n"), year).otherwise(F.col("yr")))
        .withColumn("yrd", F.when(F.col("_n") & december, year + 1).when(F.col("_n"), year).otherwise(F.col("yrd")))
        .withColumn("mond", F.when(F.col("_n") & december, 1).when(F.col("_n"), F.col("mond") + 1).otherwise(F.col("mond")))
        .drop("_n")
    )


def thirtieth(records: DataFrame) -> DataFrame:
    """End days of 31 in 360-day records become 30."""
    return records.withColumn("datd", F.when((F.col("datd") == 31) & (F.col("tim") == 2), 30).otherwise(F.col("datd")))
