import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators.timeaxis import year_range
from gridloom.sinks import writers as wr
from gridloom.sources import fields as fl
from gridloom.sources import mesh
from gridloom.sources.crosswalk import load_crosswalk
from gridloom.sources.raster import bil_cells, read_ascii_grids, read_bil
from tests.conftest import grid_frame, rows

NAN = float("nan")


def test_ascii_grid(spark, tmp_path):
    (tmp_path / "a.asc").write_text("ncols 3\nnrows 2\nxllcorner -180\nyllcorner 10.0\ncellsize 2\nNODATA_value -99\n1 2 3\n4 -99 6\n")
    got = read_ascii_grids(spark, str(tmp_path / "a.asc"))
    assert rows(got, "y", "x", "lat", "lon", "value") == [
        (0, 0, 11.0, -179.0, 4.0), (0, 1, 11.0, -177.0, None), (0, 2, 11.0, -175.0, 6.0),
        (1, 0, 13.0, -179.0, 1.0), (1, 1, 13.0, -177.0, 2.0), (1, 2, 13.0, -175.0, 3.0),
    ]


def test_bil_raster(spark, tmp_path):
    head = "BYTEORDER I\nLAYOUT BIL\nNROWS 2\nNCOLS 3\nNBANDS 1\nNBITS 8\nULXMAP 0.5\nULYMAP 89.5\nXDIM 1\nYDIM 1\nNODATA 100\n"
    for name, data in (("one", [1, 2, 3, 4, 100, 6]), ("two", [7] * 6)):
        (tmp_path / f"{name}.hdr").write_text(head)
        (tmp_path / f"{name}.bil").write_bytes(struct.pack("6B", *data))
    got = read_bil(spark, str(tmp_path))
    one = got.filter(F.col("path").contains("one"))
    assert rows(one, "y", "x", "lat", "lon", "value")[:2] == [(0, 0, 88.5, 0.5, 4.0), (0, 1, 88.5, 1.5, None)]
    assert rows(one, "y", "x", "value")[3] == (1, 0, 1.0) and got.count() == 12
    (tmp_path / "one.hdr").write_text(head + "XROT 0.5\n")
    with pytest.raises(Exception, match="rotated"):
        read_bil(spark, str(tmp_path)).count()


@pytest.mark.parametrize("kind, bits, order, skip, pad", [("UNSIGNEDINT", 8, "I", 0, 0), ("SIGNEDINT", 16, "M", 0, 0), ("UNSIGNEDINT", 16, "I", 8, 0), ("FLOAT", 32, "M", 24, 4), ("SIGNEDINT", 32, "I", 4, 8)])
def test_bil_layouts(spark, tmp_path, kind, bits, order, skip, pad):
    ny, nx = 37, 6
    rng = np.random.default_rng(3)
    dtype = np.dtype({"UNSIGNEDINT": "u", "SIGNEDINT": "i", "FLOAT": "f"}[kind] + str(bits // 8)).newbyteorder(">" if order == "M" else "<")
    data = rng.integers(0, 250, (ny, nx)).astype(dtype)
    data[3, 4] = 99
    width = nx * dtype.itemsize + pad
    body = b"\1" * skip + b"".join(r.tobytes() + b"\0" * pad for r in data)
    (tmp_path / "a.bil").write_bytes(body)
    (tmp_path / "a.hdr").write_text(f"NROWS {ny}\nNCOLS {nx}\nNBITS {bits}\nPIXELTYPE {kind}\nBYTEORDER {order}\nSKIPBYTES {skip}\nTOTALROWBYTES {width}\nULXMAP 0.5\nULYMAP 36.5\nXDIM 1\nYDIM 1\nNODATA 99\n")
    got = {(r["y"], r["x"]): (r["lat"], r["lon"], r["value"]) for r in read_bil(spark, str(tmp_path)).collect()}
    signed = data.view(dtype.str.replace("u", "i"))
    assert got == {(ny - 1 - j, i): (ny - 1 - j + 0.5, i + 0.5, None if data[j, i] == 99 else float(signed[j, i])) for j in range(ny) for i in range(nx)}


def test_crosswalk_file(spark, tmp_path):
    p = tmp_path / "walk.json"
    p.write_text(json.dumps({"source": ["Trees", "Mix", "Thirds"], "target": [1, 2, 8], "cover_map": [[1, 0, 0], [0.25, 0.5, 0.25], [0.3333, 0.3333, 0.3334]]}, indent=1))
    got = load_crosswalk(spark, str(p))
    assert rows(got, "source_type", "target_type", "pct") == [
        ("mix", 1, 25), ("mix", 2, 50), ("mix", 8, 25), ("thirds", 1, 34), ("thirds", 2, 33), ("thirds", 8, 33), ("trees", 1, 100), ("trees", 2, 0), ("trees", 8, 0)
    ]
    p.write_text(json.dumps({"source": ["a"], "target": [1, 2], "cover_map": [[0.5, 0.2]]}))
    with pytest.raises(ValueError):
        load_crosswalk(spark, str(p))
    p.write_text(json.dumps({"source": ["a"], "target": [1], "cover_map": [[0.5, 0.5]]}))
    with pytest.raises(ValueError):
        load_crosswalk(spark, str(p))


def test_fields_round_trip(spark, tmp_path):
    f = grid_frame(spark, [[1.0, None], [NAN, 4.0]])
    both = f.withColumn("field_id", F.lit("a")).unionByName(f.withColumn("field_id", F.lit("b")))
    wr.write_fields(both, str(tmp_path / "out"), fill=-9.0)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back.filter("field_id = 'a' AND NOT isnan(value)"), "y", "x", "value") == [(0, 0, 1.0), (0, 1, -9.0), (1, 1, 4.0)]
    assert back.filter("isnan(value)").count() == 2
    with pytest.raises(OverflowError):
        wr.coerce(grid_frame(spark, [[200.0]]), "byte")
    named = both.withColumn("name", F.col("field_id")).withColumn("forecast_period", F.lit(1)).drop("field_id")
    named.write.parquet(str(tmp_path / "named"))
    got = fl.load_fields(spark, str(tmp_path / "named"), ["b"])
    assert got.count() == 4 and "forecast_period" not in got.columns


def test_records_and_text_keep_their_order(spark, tmp_path):
    r = spark.createDataFrame([(1, 0, 1002, 5, 2000, 1), (1, 1, 1001, 1, 2000, 1), (1, 2, 1001, 0, 2000, 1), (1, 3, 1001, 0, 1999, 12)], "file INT, seq INT, stash INT, lev INT, yr INT, mon INT")
    wr.write_records(r, str(tmp_path / "rec"), ["file"], ["yr", "mon"])
    got = spark.read.parquet(str(tmp_path / "rec")).orderBy("pos")
    assert [x["seq"] for x in got.collect()] == [3, 0, 2, 1]
    lines = spark.range(1000).selectExpr("id", "concat('line ', id) AS text").repartition(7)
    wr.write_text(lines, str(tmp_path / "txt"), ["id"])
    parts = sorted((tmp_path / "txt").glob("part-*"))
    assert "".join(p.read_text() for p in parts).splitlines() == [f"line {i}" for i in range(1000)]


def test_selecting_records_strictly(spark):
    r = spark.createDataFrame([(1003, 1), (1003, 0), (1003, 2), (1004, 1)], "stash INT, model INT")
    assert fl.select_records(r, 1, 3, exactly=2).count() == 2
    with pytest.raises(ValueError):
        fl.select_records(r, 1, 4, exactly=2)
    with pytest.raises(ValueError):
        fl.select_records(r, 1, 3, exactly=1)


def test_gas_files(spark, tmp_path):
    for gas in ("CO2", "CH4"):
        spark.createDataFrame([(0, 182.5, 1.0), (1, 182.5, 9.0), (0, 547.5, 2.0)], "sector INT, days DOUBLE, value DOUBLE").write.parquet(str(tmp_path / gas))
    got = fl.gas_samples(spark, {g: str(tmp_path / g) for g in ("CO2", "CH4")}, 1850, 365.0)
    assert rows(got) == [("CH4", 1850.5, 1.0), ("CH4", 1851.5, 2.0), ("CO2", 1850.5, 1.0), ("CO2", 1851.5, 2.0)]


def test_mesh_checks_and_sink(spark, tmp_path):
    nodes = spark.createDataFrame([(0, 0.0, 0.0), (1, 0.0, 1.0), (2, 1.0, 0.0)], "node_id INT, lat DOUBLE, lon DOUBLE")
    faces = spark.createDataFrame([(0, [3, 1, 2])], "face_id INT, nodes ARRAY<INT>")
    assert rows(mesh.face_corners(faces, nodes)) == [(0, [1.0, 0.0, 0.0], [0.0, 0.0, 1.0])]
    wr.write_mesh(faces, nodes, str(tmp_path / "mesh"))
    assert spark.read.parquet(str(tmp_path / "mesh" / "faces")).count() == 1
    with pytest.raises(ValueError):
        mesh.check_mesh(faces.unionByName(faces), nodes)
    with pytest.raises(ValueError):
        mesh.check_mesh(spark.createDataFrame([(0, [3, 4])], "face_id INT, nodes ARRAY<INT>"), nodes)


def test_listing_breaks_lines_and_omits_the_last_comma(spark):
    s = spark.createDataFrame([("CO2", 2000 + i, 1.5e-6 * (i + 1)) for i in range(7)], "gas STRING, year INT, value DOUBLE")
    got = {(r["section"], r["gas"], r["line"]): r["text"] for r in wr.series_listing(s, ["SO4"]).collect()}
    assert got["levls", "CO2", 0] == "clim_fcg_levls_co2=1.5000e-06,3.0000e-06,4.5000e-06,6.0000e-06,7.5000e-06,9.0000e-06,"
    assert got["levls", "CO2", 1] == "    =1.0500e-05"
    assert got["years", "CO2", 0] == "clim_fcg_years_co2=2000,2001,2002,2003,2004,2005,2006"
    assert got["years", "SO4", 0] == "clim_fcg_years_so4=7*-32768" and got["nyears", "SO4", 0] == "clim_fcg_nyears_so4=0"


def test_wide_data_start_in_row_fifteen():
    head = wr.wide_header("historical", "somewhere", 1900, 2000)
    assert len(head) == 14 and "24" in head[3] and head[-1].split()[:3] == ["YEARS", "DUMM0", "CO2"]


def test_years_that_are_not_covered_raise(spark):
    s = spark.createDataFrame([(2000, 1.0), (2002, 2.0)], "year INT, value DOUBLE")
    assert year_range(s, 2000, 2002).count() == 2
    for b, e in ((2003, 2005), (2001, 2004)):
        with pytest.raises(ValueError):
            year_range(s, b, e)


def test_ascii_grid_in_several_tasks(spark, tmp_path):
    """Files cut at any line, numbers wrapped at random, headers with centres; each split knows its first cell."""
    rng = np.random.default_rng(5)
    want = {}
    for n, (ny, nx) in enumerate([(90, 70), (1, 1), (33, 200)]):
        data = rng.integers(-9, 1000, (ny, nx))
        words = [str(v) for v in data.ravel()]
        cuts = sorted({0, len(words), *rng.integers(0, len(words), len(words) // 9).tolist()})
        body = "\n".join(" ".join(words[a:b]) for a, b in zip(cuts, cuts[1:]))
        corner = "xllcenter 0.25\nyllcenter 10.25" if n else "XLLCORNER 0\nYLLCORNER 10"
        (tmp_path / f"g{n}.asc").write_text(f"ncols {nx}\nNROWS {ny}\n{corner}\ncellsize 0.5\nNODATA_value -9\n{body}\n\n")
        for j in range(ny):
            for i in range(nx):
                want[f"g{n}", ny - 1 - j, i] = (10 + (ny - 0.5 - j) * 0.5, (i + 0.5) * 0.5, None if data[j, i] == -9 else float(data[j, i]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_ascii_grids(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        found = {(r["path"][-6:-4], r["y"], r["x"]): (r["lat"], r["lon"], r["value"]) for r in got.collect()}
        assert found == want and got.count() == len(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    (tmp_path / "short.asc").write_text("ncols 3\nnrows 2\nxllcorner 0\nyllcorner 0\ncellsize 1\n1 2 3 4 5\n")
    with pytest.raises(Exception, match="5 numbers for 3"):
        read_ascii_grids(spark, str(tmp_path / "short.asc")).collect()


def test_bil_source(spark, tmp_path):
    """One scan whatever the number of files, several tasks to a file, rows chosen by bounds on y, a raster in parts that cut its rows."""
    rng = np.random.default_rng(6)
    grids = {f"r{k}": rng.integers(0, 200, (50 + k, 7)).astype("<u2") for k in range(5)}
    head = "NROWS {}\nNCOLS 7\nNBITS 16\nULXMAP 0.5\nULYMAP {}\nXDIM 1\nYDIM 1\n"
    for n, data in grids.items():
        (tmp_path / f"{n}.bil").write_bytes(data.tobytes())
        (tmp_path / f"{n}.hdr").write_text(head.format(len(data), len(data) - 0.5))
    (tmp_path / "alone.bil").write_bytes(b"12")
    whole = spark.read.format("bil").option("taskBytes", "100").load(str(tmp_path)) if read_bil(spark, str(tmp_path)) else None
    assert whole.rdd.getNumPartitions() == sum(-(-len(d) // 7) for d in grids.values())
    got = {(r["path"].rpartition("/")[2][:2], r["y"], r["x"]): r["value"] for r in whole.collect()}
    assert got == {(n, len(d) - 1 - j, i): float(d[j, i]) for n, d in grids.items() for j in range(len(d)) for i in range(7)}
    plan = read_bil(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and "Union" not in plan
    some = whole.filter("y BETWEEN 3 AND 9")
    assert some.count() == 5 * 7 * 7 and some.rdd.getNumPartitions() == 5
    raw = grids["r0"].tobytes()
    for k, (a, b) in enumerate([(0, 33), (33, 34), (34, len(raw))]):
        (tmp_path / f"part{k}").write_bytes(raw[a:b])
    one = bil_cells(spark, [str(tmp_path / f"part{k}") for k in range(3)], head.format(50, 49.5), "whole")
    assert {(r["path"], r["y"], r["x"]): r["value"] for r in one.collect()} == {("whole", 49 - j, i): float(grids["r0"][j, i]) for j in range(50) for i in range(7)}
    (tmp_path / "r0.hdr").write_text(head.format(60, 59.5))
    with pytest.raises(Exception, match="shorter than its header"):
        read_bil(spark, str(tmp_path)).count()
