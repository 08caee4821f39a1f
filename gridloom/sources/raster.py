"""Headered raster files as cells: BIL with .hdr by a data source of its own, and ASCII grids; large files are split between tasks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from gridloom.session import materialise, small

CELLS = "path STRING, y INT, x INT, lat DOUBLE, lon DOUBLE, value DOUBLE"
#: Cells that a task hands on at a time, and bytes of a BIL file that make a task.
BATCH_CELLS, TASK_BYTES = 1 << 18, 32 << 20
_BATCH_MB = 64


def _cells(path: str, row: np.ndarray, x: np.ndarray, value: pa.Array, ny: int, west: float, south: float, dx: float, dy: float) -> pa.RecordBatch:
    """Cells of raster rows counted from the north; `west` and `south` are edges."""
    y = ny - 1 - row
    cols = [pa.repeat(pa.scalar(path), len(row)), pa.array(y.astype(np.int32)), pa.array(x.astype(np.int32)), pa.array(south + (y + 0.5) * dy), pa.array(west + (x + 0.5) * dx), value]
    return pa.RecordBatch.from_arrays(cols, ["path", "y", "x", "lat", "lon", "value"])


def parse_header(text: str) -> dict[str, str]:
    """Upper-case keyword table of an ESRI style header."""
    return {p[0].upper(): p[1] for p in (line.split(None, 1) for line in text.splitlines()) if len(p) == 2}


# -- ASCII grids --------------------------------------------------------------------------------------------------

_KEYS = ("ncols", "nrows", "xllcorner", "xllcenter", "yllcorner", "yllcenter", "cellsize", "nodata_value")
_HEAD = rf"(?i)^\s*({'|'.join(_KEYS)})\s+(\S+)"


def read_ascii_grids(spark: SparkSession, path: str) -> DataFrame:
    """Cells of ASCII grids ``ncols/nrows/xllcorner/yllcorner/cellsize/NODATA_value`` + numbers from north-west to south-east.

    Lines may break anywhere between numbers.  Files are split at line ends like any text: a first pass counts the numbers of each split, and
    their running sum gives every split its first cell, so a task needs no more of a file than its own lines.  A file with more or fewer
    numbers than its header says raises.
    """
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(path).select(*place, F.monotonically_increasing_id().alias("nth"), "value")
    lines = lines.withColumn("key", F.lower(F.regexp_extract("value", _HEAD, 1)))
    number = F.regexp_extract("value", _HEAD, 2).cast("double")
    heads = [F.max(F.when(F.col("key") == k, number)).alias(k) for k in _KEYS]
    count = F.sum(F.when(F.col("key") == "", F.regexp_count("value", F.lit(r"\S+"))).otherwise(0))
    splits = materialise(lines.groupBy("path", "block").agg(count.alias("n"), *heads))
    files = splits.groupBy("path").agg(F.sum("n").alias("_all"), *[F.max(k).alias(k) for k in _KEYS])
    wrong = F.raise_error(F.format_string("%s: %s numbers for %s columns and %s rows", "path", "_all", "ncols", "nrows"))
    files = files.withColumn("_all", F.when(F.col("_all") == F.col("ncols") * F.col("nrows"), F.col("_all")).otherwise(wrong.cast("long")))
    half = [F.when(F.col(f"{a}llcenter").isNotNull(), F.col("cellsize") / 2).otherwise(0.0) for a in "xy"]
    edges = [(F.coalesce(f"{a}llcorner", f"{a}llcenter", F.lit(0.0)) - h).alias(n) for a, h, n in zip("xy", half, ("west", "south"))]
    files = files.filter("_all >= 0").select("path", "ncols", "nrows", "cellsize", "nodata_value", *edges)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    table = splits.select("path", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")).join(files, "path")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at, grid, held, size = None, 0, None, [], 0

        def ready() -> pa.RecordBatch:
            values = np.concatenate(held)
            row, x = np.divmod(np.arange(at - size, at), int(grid["ncols"]))
            # NaN is a value; only the marked number is masked.
            masked = np.zeros(len(values), bool) if grid["nodata_value"] is None else values == grid["nodata_value"]
            return _cells(key[0], row, x, pa.array(values, mask=masked), int(grid["nrows"]), grid["west"], grid["south"], grid["cellsize"], grid["cellsize"])

        for batch in batches:
            paths, blocks, texts = (batch.column(i).to_pylist() for i in range(3))
            for i, text in enumerate(texts):
                if (paths[i], blocks[i]) != key:
                    if size:
                        yield ready()
                    key, grid = (paths[i], blocks[i]), {n: batch.column(n)[i].as_py() for n in ("first", "ncols", "nrows", "cellsize", "nodata_value", "west", "south")}
                    at, held, size = grid["first"], [], 0
                numbers = np.array(text.split(), float)
                held.append(numbers)
                at, size = at + len(numbers), size + len(numbers)
                if size >= BATCH_CELLS:
                    yield ready()
                    held, size = [], 0
        if size:
            yield ready()

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.conf.get(key, None) or not 0 < _bytes(spark.conf.get(key)) <= _BATCH_MB << 20:
        spark.conf.set(key, f"{_BATCH_MB}m")
    rows = lines.filter("key = '' AND value RLIKE '\\\\S'").drop("key").join(small(table), ["path", "block"])
    rows = rows.sortWithinPartitions("path", "block", "nth").select("path", "block", "value", "first", "ncols", "nrows", "cellsize", "nodata_value", "west", "south")
    return rows.mapInArrow(decode, CELLS)


def _bytes(size: str) -> int:
    """A size setting such as 64m or 1g in bytes."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


# -- BIL ----------------------------------------------------------------------------------------------------------


def _layout(header: dict[str, str]) -> tuple[np.dtype, int, int, int, int]:
    """Pixel type, rows, columns, bytes to a row and bytes before the first one of a single-band raster."""
    if any(float(header.get(k, 0)) for k in ("XROT", "YROT")):
        raise ValueError("the raster is rotated")
    if int(header.get("NBANDS", 1)) != 1:
        raise ValueError("the raster has more than one band")
    bits, kind = int(header.get("NBITS", 8)), header.get("PIXELTYPE", "UNSIGNEDINT").upper()
    if bits not in (8, 16, 32, 64) or kind == "FLOAT" and bits < 32:
        raise ValueError(f"pixels of {bits} bits are not supported")
    order = ">" if header.get("BYTEORDER", "I").upper().startswith("M") else "<"
    dtype = np.dtype(f"{order}{ {'FLOAT': 'f', 'SIGNEDINT': 'i'}.get(kind, 'u') }{bits // 8}")
    ny, nx = int(header["NROWS"]), int(header["NCOLS"])
    width = int(header.get("TOTALROWBYTES", header.get("BANDROWBYTES", nx * dtype.itemsize)))
    return dtype, ny, nx, width, int(header.get("SKIPBYTES", 0))


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


def _text(path: str) -> str:
    store, place = _store(path)
    with store.open_input_stream(place) as f:
        return f.read().decode()


@dataclass
class Rows(InputPartition):
    """Raster rows `first` up to `last`, from the north, of the raster that lies in `files` one after the other."""

    label: str
    header: str
    files: list[tuple[str, int]]
    first: int
    last: int


class BilReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.low, self.high = options, None, None

    def pushFilters(self, filters: list) -> Iterator:
        """Bounds on `y` choose the rows that are read; Spark still applies every filter."""
        for f in filters:
            if getattr(f, "attribute", None) == ("y",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(f.value, f.value if self.low is None else self.low)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(f.value, f.value if self.high is None else self.high)
            yield f

    def rasters(self) -> Iterator[tuple[str, str, list[tuple[str, int]]]]:
        """Name, header and files with their sizes of each raster."""
        if "parts" in self.options:
            files = []
            for path in json.loads(self.options["parts"]):
                store, place = _store(path)
                files.append((path, store.get_file_info(place).size))
            yield self.options.get("label") or files[0][0], self.options["header"], files
            return
        folder = self.options["path"]
        store, place = _store(folder)
        scheme = folder[:len(folder) - len(place)] if folder.endswith(place) else ""
        found = {i.path: i for i in store.get_file_info(fs.FileSelector(place)) if i.type == fs.FileType.File}
        headers = {p.rpartition(".")[0]: p for p in found if p.lower().endswith(".hdr")}
        for path in sorted(found):
            stem, _, kind = path.rpartition(".")
            if kind.lower() == "bil" and stem in headers:
                yield scheme + path, _text(scheme + headers[stem]), [(scheme + path, found[path].size)]

    def partitions(self) -> list[Rows]:
        out = []
        for label, header, files in self.rasters():
            _, ny, _, width, skip = _layout(parse_header(header))
            if sum(size for _, size in files) < skip + ny * width - (width - 1):
                raise ValueError(f"{label} is shorter than its header says")
            north = 0 if self.high is None else max(0, ny - 1 - int(self.high))
            south = ny if self.low is None else min(ny, ny - int(self.low))
            step = max(1, int(self.options.get("taskbytes", TASK_BYTES)) // width)
            out += [Rows(label, header, files, a, min(a + step, south)) for a in range(north, south, step)]
        return out or [Rows("", "", [], 0, 0)]

    def read(self, part: Rows) -> Iterator[pa.RecordBatch]:
        if not part.files:
            return
        h = parse_header(part.header)
        dtype, ny, nx, width, skip = _layout(h)
        dx, dy = float(h["XDIM"]), float(h["YDIM"])
        west, south = float(h["ULXMAP"]) - dx / 2, float(h["ULYMAP"]) + dy / 2 - ny * dy
        nodata = float(h["NODATA"]) if "NODATA" in h else None
        step = max(1, BATCH_CELLS // nx)
        for first in range(part.first, part.last, step):
            n = min(step, part.last - first)
            raw = self._bytes(part.files, skip + first * width, n * width).ljust(n * width, b"\0")
            data = np.frombuffer(raw, np.uint8).reshape(n, width)[:, :nx * dtype.itemsize]
            pixels = np.ascontiguousarray(data).view(dtype).ravel()
            # Unsigned pixels become signed ones of the same width; the mark for no data is meant as it is written.
            masked = np.zeros(len(pixels), bool) if nodata is None else pixels.astype(float) == nodata
            value = pa.array(pixels.view(dtype.str.replace("u", "i")).astype(float), mask=masked)
            row, x = np.divmod(np.arange(n * nx), nx)
            yield _cells(part.label, first + row, x, value, ny, west, south, dx, dy)

    @staticmethod
    def _bytes(files: list[tuple[str, int]], start: int, length: int) -> bytes:
        """A range of the bytes of several files that follow each other; less at their end."""
        out = []
        for path, size in files:
            if start < size and length > 0:
                store, place = _store(path)
                with store.open_input_file(place) as f:
                    f.seek(start)
                    out.append(f.read(min(length, size - start)))
                length -= len(out[-1])
            start = max(0, start - size)
        return b"".join(out)


class BilSource(DataSource):
    """``spark.read.format("bil")``: single-band BIL rasters of a folder, each with the ``name.hdr`` beside it, or one raster in `parts`."""

    @classmethod
    def name(cls) -> str:
        return "bil"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> BilReader:
        return BilReader(dict(self.options))


def _bil(spark: SparkSession):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BilSource)
    return spark.read.format("bil")


def bil_cells(spark: SparkSession, paths: list[str], header: str, name: str | None = None) -> DataFrame:
    """Cells of one single-band BIL raster whose rows, from north to south, lie in one file or in several in order.

    Tasks read ranges of rows, so a large file is split between them; bounds on `y` reach the source.  Files are opened by pyarrow, so they
    must lie where that reads.  Unsigned pixels become signed ones of the same width; `name` is the column `path`.
    """
    return _bil(spark).option("parts", json.dumps(list(paths))).option("header", header).option("label", name or "").load()


def read_bil(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of all single-band BIL rasters of a folder, by one scan; each ``name.bil`` is read with the ``name.hdr`` beside it."""
    return _bil(spark).load(folder)
