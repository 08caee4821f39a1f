"""Sinks: fields, record files, gas listings, meshes, river tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gridloom.functions.columns import MISSING_REAL, sentinel
from gridloom.session import attach, merged, rank_within

# Type -> (smallest, largest) of the integer types a classic file holds.
RANGES = {"byte": (-128, 127), "short": (-32768, 32767), "int": (-2147483648, 2147483647)}


def valid_range(cells: DataFrame, by: list[str] | None = None, value: str = "value") -> DataFrame:
    known = F.when(~F.isnan(F.col(value).cast("double")), F.col(value))
    return cells.groupBy(*(by or [])).agg(F.min(known).alias("valid_min"), F.max(known).alias("valid_max"))


def coerce(cells: DataFrame, to: str, value: str = "value") -> DataFrame:
    """Cast to a type the file format has; a value out of range raises instead of wrapping."""
    if to in RANGES:
        low, high = RANGES[to]
        if cells.filter((F.col(value) < low) | (F.col(value) > high)).limit(1).count():
            raise OverflowError(f"values do not fit into {to}")
    return cells.withColumn(value, F.col(value).cast(to))


def write_fields(cells: DataFrame, path: str, to: str | None = None, fill: float | None = None, value: str = "value", keys: list[str] | None = None) -> None:
    """One folder per field, slices kept together and sorted so that index columns compress to almost nothing."""
    out = coerce(cells, to, value) if to else cells
    if fill is not None:
        out = out.withColumn(value, sentinel(F.col(value), fill))
    keys = keys or [c for c in ("t", "z", "pl", "y", "x") if c in out.columns]
    by = ["field_id"] if "field_id" in out.columns else []
    ordered = out.repartitionByRange(*by, *keys).sortWithinPartitions(*by, *keys)
    writer = ordered.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def record_order(fields: DataFrame, by: list[str], time: list[str], level: str = "lev") -> DataFrame:
    """Position `pos` of each 2-D field within its file: by time, then item code as first met, then level."""
    first = attach(fields, [*by, "stash"], F.min("seq").alias("_first"))
    return rank_within(first, by, [F.asc(c) for c in (*time, "_first", level, "seq")], "pos").drop("_first")


def write_records(fields: DataFrame, path: str, by: list[str], time: list[str], level: str = "lev") -> None:
    out = record_order(fields, by, time, level)
    out.repartitionByRange(*by, "pos").sortWithinPartitions(*by, "pos").write.mode("errorifexists").parquet(path)


def emissions(cells: DataFrame, value: str = "value") -> DataFrame:
    """Single precision without masks: masked cells hold zero; 32-bit integers stay as they are."""
    filled = F.coalesce(F.col(value), F.lit(0))
    kind = dict(cells.dtypes)[value]
    return cells.withColumn(value, filled if kind == "int" else filled.cast("float"))


def emission_attributes(attributes: DataFrame) -> DataFrame:
    """Attribute table ``(field_id, name, text)`` with emission_type renamed update_type and whole numbers as integers."""
    name = F.when(F.col("name") == "emission_type", "update_type").otherwise(F.col("name"))
    whole = F.col("text").rlike(r"^-?[0-9]+(\.0*)?$")
    text = F.when(whole, F.col("text").cast("double").cast("long").cast("string")).otherwise(F.col("text"))
    return attributes.withColumn("name", name).withColumn("text", text)


def _lines(series: DataFrame, key: list[str], item: Column, per_line: int, order: str) -> DataFrame:
    """Items joined by commas, `per_line` to a line ``(key..., line, text)``; the last item has no comma behind it."""
    w = Window.partitionBy(*key).orderBy(order)
    rows = series.withColumn("_rn", F.row_number().over(w)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    text = F.concat(item, F.when(F.col("_rn") < F.col("_n"), ",").otherwise(""))
    rows = rows.select(*key, F.floor((F.col("_rn") - 1) / per_line).cast("int").alias("line"), "_rn", text.alias("_t"))
    joined = rows.groupBy(*key, "line").agg(F.array_sort(F.collect_list(F.struct("_rn", "_t"))).alias("_a"))
    return joined.select(*key, "line", F.array_join(F.transform("_a", lambda a: a["_t"]), "").alias("text"))


@F.pandas_udf(StringType())
def scientific(values: pd.Series) -> pd.Series:
    """Exponent format with four decimals, e.g. 1.2345e-06.

    Rounds the binary value as C does; the JVM's own formatter rounds its shortest decimal text instead.
    """
    return values.map(lambda v: None if pd.isna(v) else f"{v:.4e}")


def series_listing(series: DataFrame, unused: list[str] | None = None) -> DataFrame:
    """Configuration lines ``(section, gas, line, text)`` of yearly series ``(gas, year, value)``.

    Concentrations come six and years twelve to a line; gases without data get fill entries of the same length.
    """
    def block(section: str, item: Column, per_line: int) -> DataFrame:
        out = _lines(series, ["gas"], item, per_line, "year")
        head = F.concat(F.lit(f"clim_fcg_{section}_"), F.lower("gas"), F.lit("="))
        return out.select(F.lit(section).alias("section"), "gas", "line", F.concat(F.when(F.col("line") == 0, head).otherwise("    ="), "text").alias("text"))

    counts = series.groupBy("gas").agg(F.count(F.lit(1)).alias("n"))

    def single(df: DataFrame, section: str, tail: Column) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"), "gas", F.lit(0).alias("line"),
            F.concat(F.lit(f"clim_fcg_{section}_"), F.lower("gas"), F.lit("="), tail).alias("text"),
        )

    n = F.col("n").cast("string")
    out = block("levls", scientific(F.col("value")), 6).unionByName(block("years", F.col("year").cast("string"), 12))
    out = out.unionByName(single(counts, "nyears", n)).unionByName(single(counts, "rates", F.concat(n, F.lit("*-32768.0"))))
    if unused:
        longest = counts.agg(F.max("n").alias("n"))
        idle = longest.withColumn("gas", F.explode(F.array(*[F.lit(g) for g in unused])))
        for section, tail in (
            ("levls", F.concat(n, F.lit("*-32768.0"))), ("nyears", F.lit("0")),
            ("rates", F.concat(n, F.lit("*-32768.0"))), ("years", F.concat(n, F.lit("*-32768"))),
        ):
            out = out.unionByName(single(idle, section, tail))
    return out


# Column order of the chemistry table, and the source and factor of its placeholder columns.
CHEMISTRY_COLUMNS = (
    "DUMM0 CO2 CH4 N2O HFC125 HFC134a CFC_11 CFC_12 DUMM1 CFC_113 CFC_114 CFC_115 CARB_TET MCF HCFC_22 HCFC_141B "
    "HCFC_142B HALON1211 HALON1202 HALON1301 HALON2402 CH3BR CH3CL DUMM2"
).split()
CHEMISTRY_PLACEHOLDERS = {"DUMM0": ("CFC_12", -1.0e6), "DUMM1": ("CFC_12", -1.0e6), "DUMM2": ("CFC_12", -1.0e6), "HALON1202": ("HALON1211", 0.0)}


def wide_table(series: DataFrame, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """One row per year, one column per gas in a set order; placeholder columns are scaled copies of another gas."""
    columns = columns or CHEMISTRY_COLUMNS
    real = [c for c in columns if c not in CHEMISTRY_PLACEHOLDERS]
    wide = series.groupBy(*(by or []), "year").pivot("gas", real).agg(F.first("value"))
    out = [
        (F.col(CHEMISTRY_PLACEHOLDERS[c][0]) * CHEMISTRY_PLACEHOLDERS[c][1]).alias(c) if c in CHEMISTRY_PLACEHOLDERS else F.col(c)
        for c in columns
    ]
    return wide.select(*(by or []), "year", *out)


def wide_lines(wide: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fixed-format text of each year: three blanks and the year, then four blanks and each number."""
    columns = columns or CHEMISTRY_COLUMNS
    text = F.concat(F.format_string("   %d", F.col("year")), *[F.concat(F.lit("    "), scientific(F.col(c))) for c in columns])
    return wide.select("year", text.alias("text"))


def wide_header(project: str, source: str, begin: int, end: int, columns: list[str] | None = None, units: list[str] | None = None) -> list[str]:
    columns = columns or CHEMISTRY_COLUMNS
    units = units or ["ppm" if c == "CO2" else "ppb" if c in ("CH4", "N2O") else "ppt" for c in columns]
    facts = {"DATACOLUMNS": len(columns), "FIRSTYEAR": begin, "LASTYEAR": end, "ANNUALSTEPS": 1, "FIRSTDATAROW": 15}
    return [
        f"! {project} GHG data for CMIP6 ", f"! source: {source} ", " &THISFILE_SPECIFICATIONS ",
        *[f" THISFILE_{k:<15} = {v:>11}, " for k, v in facts.items()],
        " THISFILE_UNITS          =  SEE ROW 13, ", " THISFILE_DATTYPE        =  RCPDAT ", "/ ",
        "   COLUMN:   " + "".join(f"   {i}" for i in range(1, len(columns) + 1)),
        "   UNITS:   " + "".join(f"   {u}" for u in units), "   YEARS   " + "".join(f"   {c}" for c in columns),
    ]


def write_text(lines: DataFrame, path: str, order: list[str], text: str = "text") -> None:
    """Text lines in order; range partitions keep the order across part files."""
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select(F.col(text).alias("value")).write.mode("errorifexists").text(path)


def write_mesh(faces: DataFrame, nodes: DataFrame, path: str) -> None:
    """Faces and nodes as a pair of tables, after the numbering checks."""
    from gridloom.sources.mesh import check_mesh

    check_mesh(faces, nodes)
    faces.write.mode("errorifexists").parquet(path + "/faces")
    nodes.write.mode("errorifexists").parquet(path + "/nodes")


def mesh_fields_consistent(fields: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per field: is its name unique, and do all fields sit on one topology, i.e. on the same rows of `keys`?"""
    keys = keys or ["face_id", "lat", "lon"]
    f = fields.groupBy("field_id", "name").agg(F.count(F.lit(1)).alias("faces"))
    names = f.groupBy("name").agg(F.count(F.lit(1)).alias("_uses"))
    n = f.select("field_id").distinct().count()
    per = fields.groupBy("field_id", *keys).agg(F.count(F.lit(1)).alias("_c"))
    shared = per.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_c").alias("_a"), F.max("_c").alias("_b"))
    same = shared.filter((F.col("_n") != n) | (F.col("_a") != F.col("_b"))).limit(1).count() == 0
    return f.join(names, "name").select("field_id", "name", "faces", (F.col("_uses") == 1).alias("unique_name"), F.lit(same).alias("same_topology"))


def ocean_river_table(interior: DataFrame, positions: DataFrame) -> DataFrame:
    """River numbers on the whole ocean grid ``(y, x, nav_lat, nav_lon)``; cells outside the numbered interior get 0."""
    return positions.join(merged(interior.select("y", "x", "river")), ["y", "x"], "left").withColumn("river", F.coalesce("river", F.lit(0)))


def fill_value(kind: str) -> float:
    """Sentinel by kind of file."""
    # Fixed values.
    return {"record": MISSING_REAL, "mask": -1.0, "class": 0.0, "percent": 100.0}[kind]
