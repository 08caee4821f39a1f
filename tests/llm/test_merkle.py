import hashlib
import zlib

from pyspark.sql import functions as F

from gridloom.llm import merkle
from gridloom.llm.merkle import Block, climb, depth, manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, hash string, tree long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """All levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, at):
    out = []
    for nodes in levels[:-1]:
        start = at // 3 * 3
        out += nodes[start:at] + nodes[at + 1:start + 3]
        at //= 3
    return out


def changed(levels, at, node):
    """The root of the whole tree built anew with another leaf."""
    return tree([*levels[0][:at], node, *levels[0][at + 1:]])[-1][0]


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf(r) for r in sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, r in enumerate(sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            bad = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf((*r[:4], r[4].replace("\n", ""))) if bad else leaf(r)
            root = changed(top, k, changed(trees[s], at, node))
            proof = h(*siblings(trees[s], at), *siblings(top, k))
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], proof, root, root == top[-1][0]))
    return sorted(out, key=repr)


def got(df):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    out = manifest(df, tampered={"text": F.replace("text", F.lit("\n"), F.lit(""))}, when=even)
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in cols) for r in out.collect()), key=repr)


def test_block():
    for n in (1, 2, 3, 4, 9, 10, 27, 28, 80):
        nodes = [h(str(i)) for i in range(n)]
        block, levels = Block(nodes, depth(n)), tree(nodes)
        assert block.levels == levels
        for at in {0, n // 2, n - 1}:
            assert "".join(block.path(at)) == "".join(siblings(levels, at))
            assert climb(nodes[at], block.path(at)) == [x[at // 3 ** (k + 1)] for k, x in enumerate(levels[1:])]
            version = block.copy(at, h("x"))
            assert not n > 1 or version[-1] == changed(levels, at, h("x"))
            # The tree itself is untouched, and the version copies one node a level.
            assert block.levels == levels and len(version) == depth(n)


def test_whole_table(documents):
    cols = list(merkle.FIELDS)
    assert got(documents) == brute([tuple(r[c] for c in cols) for r in documents.collect()])


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = [(i, "hot" if i % 3 else None, "en", i, f"line\n{i}" if i % 5 else None, "x", 1) for i in range(200)]
    rows += [(500, "é", None, None, "", "x", 1), (500, "é", None, None, "", "x", 1), (None, "é", "en", 2, "a\nb", None, 1), (None, None, None, None, None, None, None)]
    rows += [(600 + i, f"s{i}", "de", 7, "x" * 200_000 + "\n" if i == 2 else "\n\n", "y", 2) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert got(df) == brute([r[:5] for r in rows])


def test_small_tables(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    one = [(2, "a", "en", 3, "a\nb", None, None)]
    assert got(spark.createDataFrame(one, SCHEMA)) == brute([r[:5] for r in one])
    each = [(i, f"s{i}", "en", 3, f"a\n{i}", None, None) for i in range(5)]
    assert got(spark.createDataFrame(each, SCHEMA)) == brute([r[:5] for r in each])


def test_versions(spark):
    df = spark.createDataFrame([(i, "a", "en", 1, "x", None, None) for i in range(30)], SCHEMA)
    out = manifest(df, tampered={"text": F.lit("y")}, when=F.col("doc_id") == 7).collect()
    assert all((r.copied is None) == (r.doc_id != 7) for r in out)
    bad = next(r for r in out if r.doc_id == 7)
    assert len(bad.copied) == depth(30) and bad.copied[-1] == bad.folded_root != bad.root and not bad.verified
    assert all(r.verified for r in out if r.doc_id != 7)
