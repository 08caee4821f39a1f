"""Unstructured meshes: faces with their corner nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def face_corners(faces: DataFrame, nodes: DataFrame, start_index: int = 1, by: list[str] | None = None) -> DataFrame:
    """Corner coordinates of each face in order: arrays `lats` and `lons`; faces are bounded by their few corners."""
    by = by or []
    c = faces.select(*by, "face_id", F.posexplode("nodes").alias("_pos", "_node"))
    c = c.withColumn("node_id", F.col("_node") - start_index).join(nodes, by + ["node_id"])
    ring = F.array_sort(F.collect_list(F.struct("_pos", "lat", "lon")))
    out = c.groupBy(*by, "face_id").agg(ring.alias("_r"))
    return out.select(
        *by, "face_id", F.transform("_r", lambda r: r["lat"]).alias("lats"), F.transform("_r", lambda r: r["lon"]).alias("lons")
    )


def check_mesh(faces: DataFrame, nodes: DataFrame, start_index: int = 1) -> None:
    """Faces and nodes must be numbered once, and faces may only use nodes that exist."""
    if faces.groupBy("face_id").count().filter("count > 1").limit(1).count():
        raise ValueError("a face number occurs twice")
    if nodes.groupBy("node_id").count().filter("count > 1").limit(1).count():
        raise ValueError("a node number occurs twice")
    used = faces.select(F.explode("nodes").alias("_n")).select((F.col("_n") - start_index).alias("node_id")).distinct()
    if used.join(nodes, "node_id", "left_anti").limit(1).count():
        raise ValueError("a face uses a node that does not exist")
