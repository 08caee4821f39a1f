"""Merkle manifest of a table: rows are leaves, runs of `ARITY` nodes become their hash, per source and then over all sources.

A tree is persistent: nodes never change.  A tampered leaf makes a version of its own, which copies the ancestors of that leaf and shares
every other node.  The work is cut into aligned blocks of `ARITY ** LEVELS` nodes.  A task hashes the blocks it gets; their roots are the
nodes of the next, much smaller stage, until one node is left.  Then the paths come down again, one row per block: a task rebuilds its blocks,
copies the ancestors of tampered leaves inside them and continues each version over the shared upper nodes, so no task ever holds all versions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import scale
from gridloom.session import discard, global_rank, lookup, materialise, row_count

#: Nodes in a run, and levels of a block: a task holds one block of ARITY ** LEVELS nodes at a time.
ARITY, LEVELS = 3, 6
#: Columns that make a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above `n` nodes until one is left."""
    out = 0
    while n > 1:
        n, out = -(-n // ARITY), out + 1
    return out


def leaf_hash(values: list[Column]) -> Column:
    """Hash of a row: per value `-` if null, else its UTF-8 byte count, a colon and the value."""
    text = [v.cast("string") for v in values]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


class Block:
    """The tree over consecutive nodes that start at a multiple of the block's width."""

    def __init__(self, nodes: list[str], levels: int):
        self.levels = [nodes]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([digest(below[i:i + ARITY]) for i in range(0, len(below), ARITY)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def path(self, at: int) -> list[str]:
        """Per level the siblings to the left of a node and to its right, each joined."""
        out = []
        for nodes in self.levels[:-1]:
            start = at - at % ARITY
            out += ["".join(nodes[start:at]), "".join(nodes[at + 1:start + ARITY])]
            at //= ARITY
        return out

    def copy(self, at: int, node: str) -> list[str]:
        """The version in which one node is another: its copied ancestors from below; all other nodes are those of this tree."""
        out = []
        for nodes in self.levels[:-1]:
            start = at - at % ARITY
            node = digest([*nodes[start:at], node, *nodes[at + 1:start + ARITY]])
            out.append(node)
            at //= ARITY
        return out


def climb(node: str, path: list[str]) -> list[str]:
    """The ancestors of a node over the siblings in `path`."""
    out = []
    for before, after in zip(path[::2], path[1::2]):
        node = digest([before, node, after])
        out.append(node)
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[dict]]]:
    """Rows sorted by tree and block -> one block at a time."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = row["tree"], row["block"]
            if key != at and held:
                yield *at, held
                held = []
            at = key
            held.append(row)
    if held:
        yield *at, held


def _dealt(nodes: DataFrame) -> DataFrame:
    """`nodes` with their block; the rows of a block are together and in order."""
    rows = nodes.withColumn("block", F.expr(f"pos DIV {ARITY ** LEVELS}"))
    return rows.repartition(scale(nodes), "tree", "block").sortWithinPartitions("tree", "block", "pos")


def _out(rows: list[dict], schema: pa.Schema, limit: int) -> Iterator[pa.RecordBatch]:
    if len(rows) >= limit:
        yield pa.RecordBatch.from_pylist(rows, schema)
        rows.clear()


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("tree", pa.int64()), ("pos", pa.int64()), ("n", pa.int64()), ("hash", pa.string())])
    rows: list[dict] = []
    for tree, block, held in _runs(batches):
        n = held[0]["n"]
        levels = min(LEVELS, depth(n))
        rows.append({"tree": tree, "pos": block, "n": -(-n // ARITY ** levels), "hash": Block([r["hash"] for r in held], levels).root})
        yield from _out(rows, schema, 1000)
    yield from _out(rows, schema, 1)


def _stages(nodes: DataFrame) -> list[DataFrame]:
    """Node tables ``(tree, pos, n, hash)`` from `nodes` up to one node per tree."""
    stages = [nodes]
    while stages[-1].filter("n > 1").limit(1).count():
        stages.append(materialise(_dealt(stages[-1].select("tree", "pos", "n", "hash")).mapInArrow(_up, "tree long, pos long, n long, hash string")))
    return stages


def _with_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes and, ahead of each block, the row that holds the path of its root."""
    above = paths.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "path", "subroot", "root")
    rows = nodes.withColumn("block", F.expr(f"pos DIV {ARITY ** LEVELS}")).unionByName(above, allowMissingColumns=True)
    return rows.repartition(scale(nodes), "tree", "block").sortWithinPartitions("tree", "block", "pos")


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    strings = pa.string()
    schema = pa.schema([("tree", pa.int64()), ("pos", pa.int64()), ("path", pa.list_(strings)), ("subroot", strings), ("root", strings)])
    rows: list[dict] = []
    for tree, _, (head, *held) in _runs(batches):
        block = Block([r["hash"] for r in held], min(LEVELS, depth(held[0]["n"])))
        for at, r in enumerate(held):
            rows.append({"tree": tree, "pos": r["pos"], "path": block.path(at) + head["path"], "subroot": head["subroot"], "root": head["root"]})
        yield from _out(rows, schema, 1000)
    yield from _out(rows, schema, 1)


def _leaf_schema(kind: pa.DataType) -> pa.Schema:
    strings = pa.string()
    kinds = [("leaf", strings), ("subroot", strings), ("root", strings), ("proof", pa.list_(strings)), ("proof_sha256", strings),
             ("copied", pa.list_(strings)), ("folded_root", strings), ("verified", pa.bool_())]
    return pa.schema([("id", kind), *kinds])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[dict] = []
    schema = None

    def known() -> Iterator[pa.RecordBatch]:
        nonlocal schema
        for batch in batches:
            schema = schema or _leaf_schema(batch.schema.field("id").type)
            yield batch

    for _, _, (head, *held) in _runs(known()):
        block = Block([r["hash"] for r in held], min(LEVELS, depth(held[0]["n"])))
        upper = head["path"]
        for at, r in enumerate(held):
            proof = block.path(at) + upper
            # Without tampering the version is the tree itself, folded all the same.
            own = block.copy(at, r["tampered"] or r["hash"])
            version = own + climb(own[-1] if own else r["tampered"] or r["hash"], upper)
            folded = version[-1] if version else r["tampered"] or r["hash"]
            rows.append({
                "id": r["id"], "leaf": r["hash"], "subroot": head["subroot"], "root": head["root"], "proof": proof, "proof_sha256": digest(proof),
                "copied": version if r["tampered"] else None, "folded_root": folded, "verified": folded == head["root"],
            })
            if len(rows) >= 1000:
                yield from _out(rows, schema, 1000)
    yield from _out(rows, schema, 1)


def _descend(stages: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the nodes of the first of `stages`, given those of the last; tables that are done with are deleted."""
    for nodes in reversed(stages[:-1]):
        below = materialise(_with_paths(nodes.select("tree", "pos", "n", "hash"), paths).mapInArrow(_down, "tree long, pos long, path array<string>, subroot string, root string"))
        discard(paths, nodes)
        paths = below
    return paths


def manifest(
    docs: DataFrame, id: str = "doc_id", by: str = "source", fields: tuple[str, ...] = FIELDS, tampered: dict[str, Column] | None = None,
    when: Column | None = None,
) -> DataFrame:
    """``(id, leaf, subroot, root, proof, proof_sha256, copied, folded_root, verified)`` per row of `docs`.

    Per value of `by`, leaves ascend by `id` (null first, equal ids by leaf, so equal rows are next to each other); runs of `ARITY` nodes
    become their hash until one is left, the subroot.  Subroots in the order of `by` (null first, then bytewise) give the root in the same way.
    `proof` holds per level the siblings to the left and to the right.  `tampered` replaces values of fields in rows where `when` holds (a null
    condition does not): `folded_root` comes from that leaf and the original siblings, `copied` are the nodes that its version does not
    share.  A value that does not change leaves the row as it is, with no version.  Nulls are values of their own and empty texts are not
    null; repeated rows are leaves of their own; an empty table gives an empty result; columns not in `fields` are not read.
    """
    values = [F.col(c) for c in fields]
    changed = [(tampered or {}).get(c, F.col(c)) for c in fields]
    other = F.when(F.coalesce(when if when is not None else F.lit(bool(tampered)), F.lit(False)), leaf_hash(changed))
    key = F.when(F.col(by).isNull(), "").otherwise(F.concat(F.lit("="), F.col(by).cast("string")))
    rows = docs.select(F.col(id).alias("id"), key.alias("key"), leaf_hash(values).alias("hash"), other.alias("tampered"))
    rows = materialise(rows.withColumn("tampered", F.when(F.col("tampered") != F.col("hash"), F.col("tampered"))))
    ranked = materialise(global_rank(rows, [F.asc("key"), F.asc("id"), F.asc("hash")], "_g"))
    discard(rows)
    sources = materialise(ranked.groupBy("key").agg(F.min("_g").alias("_first"), F.count(F.lit(1)).alias("n")))
    sources = materialise(global_rank(sources, [F.asc("_first")], "_s").withColumn("tree", F.col("_s") - 1).drop("_s"))
    placed = lookup(ranked, sources, ["key"]).withColumn("pos", F.col("_g") - F.col("_first")).select("tree", "pos", "n", "hash", "tampered", "id")
    leaves = materialise(placed)
    trees = _stages(leaves)
    upper = _stages(materialise(trees[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(row_count(sources)).cast("long").alias("n"), "hash")))
    none = F.array().cast("array<string>")
    top = upper[-1].select("tree", "pos", none.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    paths = _descend(upper, top)
    paths = paths.select(F.col("pos").alias("tree"), "path", "root")
    # One subroot a source: as many rows as there are sources.
    subroots = trees[-1].select("tree", "pos", F.col("hash").alias("subroot")).join(paths, "tree").select("tree", "pos", "path", "subroot", "root")
    if len(trees) == 1:
        # Every source has one row: leaves are subroots, and a block of one node stands on the path of its subroot.
        last = subroots
    else:
        last = _descend(trees[1:], subroots)
    kind = docs.schema[id].dataType.simpleString()
    schema = (f"id {kind}, leaf string, subroot string, root string, proof array<string>, proof_sha256 string, copied array<string>, "
              "folded_root string, verified boolean")
    return _with_paths(leaves, last).mapInArrow(_fold, schema).withColumnRenamed("id", id)
