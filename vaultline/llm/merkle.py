"""Merkle manifest of a table: a tree per group of rows, a tree over the groups' roots, and a proof for every row.

A leaf is the SHA-256 of a row's columns.  The leaves of a group stand in the order of their keys; ``FAN`` consecutive
nodes have their hash as parent until one node is left.  The groups' roots are the leaves of the top tree.

1. Rows are sorted into ranges and numbered there; the ranges' counts give every leaf its place in its tree.
2. Trees are built ``STEP`` levels at a time: a task gets ``FAN ** STEP`` consecutive nodes and hashes upwards.
3. Proofs by octopus multiproof: a *leaf partition* is ``PART`` consecutive leaves, of one tree or of many.  It works out
   the coordinates of the nodes that its leaves' proofs need and that it cannot derive itself, which is per level at
   most the rest of the run at its left and at its right end; their union over all its leaves is fetched by one join.
   Then it derives the interior nodes that its leaves share and expands each leaf's own proof from them.

No step holds more than a leaf partition: the nodes that are ever fetched are those of runs that lie in several
partitions, and the number of ranges (``spark.sql.shuffle.partitions``) is all that the driver sees, beside the root.

Defined cases: a null in a column is hashed as ``-``; a null key or group comes first; equal keys are ordered by leaf,
and rows equal in both have equal leaves, places side by side and so proofs of their own; texts may be empty or of any
length; other columns are not read; an empty table gives an empty result (and no root).
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_mod, saved, table

FAN = 16
STEP = 3
PART = 1 << 14
TOP = -1  # the top tree's number; the groups' trees are numbered from 0 in their order
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5


def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(*columns: Column) -> Column:
    """The SHA-256 of columns, each with its length in bytes before it."""
    return F.sha2(F.concat(*[_field(c) for c in columns]).cast("binary"), 256)


def _digest(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def _numbered(batches):
    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        n = b.num_rows
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())],
            names=[*b.schema.names, "_range", "_at"])
        at += n


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``rank``, their place from 0 in the order of the columns; equal rows in any order.

    A drawn number after the columns splits rows that are equal in all of them over several ranges.
    """
    spark = rows.sparkSession
    by = [*order, "_draw"]
    ranges = rows.withColumn("_draw", F.rand(len(order))).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by)
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    sorted_rows = saved(ranges.sortWithinPartitions(*by).drop("_draw").mapInArrow(_numbered, f"{kind}, _range int, _at bigint"), "merkle-ranked")
    before, offsets = 0, []
    # a row for each range, of which there are as many as shuffle partitions
    for r in sorted_rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).orderBy("_range").collect():
        offsets.append((r["_range"], before))
        before += r["n"]
    places = spark.createDataFrame(offsets, "_range int, _before bigint")
    return sorted_rows.join(places, "_range").withColumn("rank", F.col("_before") + F.col("_at")).drop("_range", "_before", "_at")


# ------------------------------------------------------------------ building
def _upwards(base: int):
    """Parents over ``STEP`` levels from rows (tree, pos, hash, size) that come in order, whole stretches at a time."""
    def run(batches):
        runs: list[list[bytes]] = [[] for _ in range(STEP)]
        for batch in batches:
            made = []
            for tree, pos, node, size in zip(*(batch.column(c).to_pylist() for c in ("tree", "pos", "hash", "size"))):
                for step in range(STEP):
                    if size == 1:
                        break
                    runs[step].append(node)
                    if pos % FAN < FAN - 1 and pos < size - 1:
                        break
                    node, pos, size = _digest(runs[step]), pos // FAN, -(-size // FAN)
                    runs[step] = []
                    made.append((tree, base + step + 1, pos, node, size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64()))],
                names=["tree", "level", "pos", "hash", "size"])
    return run


def _built(nodes: DataFrame, largest: int) -> DataFrame:
    """All interior nodes (tree, level, pos, hash, size) over ``nodes`` (tree, pos, hash, size), the trees' leaves; ``size``
    is the number of nodes on the level.  ``largest`` is the largest tree's size."""
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = "tree bigint, level int, pos bigint, hash binary, size bigint"
    out, base = nodes.sparkSession.createDataFrame([], kind), 0
    while largest > 1:
        stretch = F.floor(F.col("pos") / F.lit(FAN ** STEP))
        made = saved(nodes.where("size > 1").select("tree", "pos", "hash", "size").repartition(n, F.col("tree"), stretch)
                     .sortWithinPartitions("tree", "pos").mapInArrow(_upwards(base), kind), "merkle-nodes")
        out = out.unionByName(made)
        base, largest = base + STEP, -(-largest // FAN ** STEP)
        nodes = made.where(F.col("level") == base)
    return out


# ------------------------------------------------------------------ proofs
def missing(lo: int, hi: int, size: int):
    """(level, pos) of the nodes that the proofs of leaves lo..hi of a tree need and that these leaves don't give."""
    level = 0
    while size > 1:
        for pos in range(lo - lo % FAN, lo):
            yield level, pos
        for pos in range(hi + 1, min(hi - hi % FAN + FAN, size)):
            yield level, pos
        lo, hi, size, level = lo // FAN, hi // FAN, -(-size // FAN), level + 1


def _coordinates(batches):
    for batch in batches:
        want = [(part, tree, level, pos)
                for part, tree, lo, hi, size in zip(*(batch.column(c).to_pylist() for c in ("part", "tree", "lo", "hi", "size")))
                for level, pos in missing(lo, hi, size)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w[i] for w in want], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
            names=["part", "tree", "level", "pos"])


def _climbed(fetched: dict, tree: int, lo: int, size: int, own: list[bytes]) -> tuple[list[list[list[bytes]]], bytes]:
    """The runs of each level around consecutive leaves of a tree, from ``own`` and the fetched nodes, and the tree's root."""
    levels, level = [], 0
    while size > 1:
        hi = lo + len(own) - 1
        left = [fetched[tree, level, p] for p in range(lo - lo % FAN, lo)]
        right = [fetched[tree, level, p] for p in range(hi + 1, min(hi - hi % FAN + FAN, size))]
        row = left + own + right
        runs = [row[i:i + FAN] for i in range(0, len(row), FAN)]
        levels.append(runs)
        own, lo, size, level = [_digest(r) for r in runs], lo // FAN, -(-size // FAN), level + 1
    return levels, own[0]


def _path(levels, lo: int, pos: int):
    """(nodes left, nodes right) beside a leaf and its ancestors, level by level."""
    out = []
    for runs in levels:
        run, i = runs[pos // FAN - lo // FAN], pos % FAN
        out.append((run[:i], run[i + 1:]))
        lo, pos = lo // FAN, pos // FAN
    return out


def _expanded(trees: int):
    def run(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        fetched = {(t, v, p): h for t, v, p, h in zip(*(nodes.column(c).to_pylist() for c in ("tree", "level", "pos", "hash")))}
        leaves = leaves.sort_by([("tree", "ascending"), ("pos", "ascending")])
        rows = list(zip(*(leaves.column(c).to_pylist() for c in ("tree", "pos", "size", "hash", "claim"))))
        groups = [(t, list(g)) for t, g in groupby(rows, key=lambda r: r[0])]
        climbed = [_climbed(fetched, t, own[0][1], own[0][2], [r[3] for r in own]) for t, own in groups]
        first = groups[0][0]
        top, root = _climbed(fetched, TOP, first, trees, [c[1] for c in climbed])
        subroots, proofs, folded = [], [], []
        for (t, own), (levels, subroot) in zip(groups, climbed):
            above = _path(top, first, t)
            for _, pos, _, leaf, claim in own:
                path = _path(levels, own[0][1], pos) + above
                node = claim or leaf
                for left, right in path:
                    node = _digest([*left, node, *right])
                subroots.append(subroot)
                proofs.append(_digest([x for left, right in path for x in (*left, *right)]))
                folded.append(node)
        columns = [leaves.column("_key"), *(pa.array(c, pa.binary()).cast(pa.string()) for c in (
            [r[3] for r in rows], subroots, [root] * len(rows), proofs, folded))]
        return pa.table(columns, names=["_key", "leaf", "subroot", "derived_root", "proof_sha256", "folded_root"])
    return run


def manifest(rows: DataFrame, group: str, order: str, leaf: Column, claim: Column | None = None) -> DataFrame:
    """Per row: ``_key`` (its ``group`` and ``order`` columns), leaf, subroot, root, proof_sha256, folded_root, verified.

    ``claim`` is the leaf of a row as another copy of the table has it (null: as here); folded_root is what that copy's
    leaf gives with this one's siblings, and verified whether it is the root.  derived_root is the root as the row's leaf
    partition derived it from its own leaves and the nodes it fetched.
    """
    claim = F.lit(None).cast("string") if claim is None else claim
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    leaves = saved(ranked(rows.select(F.struct(group, order).alias("_key"), F.col(group).alias("_group"), F.col(order).alias("_order"),
                                      leaf.cast("binary").alias("hash"), claim.cast("binary").alias("claim")),
                          "_group", "_order", "hash"), "merkle-leaves")
    groups = leaves.groupBy("_group").agg(F.min("rank").alias("start"), F.count(F.lit(1)).alias("size"))
    trees = saved(ranked(groups, "_group").withColumnRenamed("rank", "tree"), "merkle-trees")
    count, largest = trees.agg(F.count(F.lit(1)), F.max("size")).first()
    placed = saved(leaves.join(trees.withColumnRenamed("_group", "_of"), F.col("_group").eqNullSafe(F.col("_of"))).select(
        "_key", "hash", "claim", "tree", (F.col("rank") - F.col("start")).alias("pos"), "size", "start",
        F.floor(F.col("rank") / PART).alias("part")), "merkle-placed")
    interior = _built(placed, largest or 0)
    subroots = placed.where("size = 1").select("tree", "hash").unionByName(interior.where("size = 1").select("tree", "hash"))
    tops = saved(subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "hash", F.lit(count).cast("bigint").alias("size")), "merkle-subroots")
    above = _built(tops, count)
    # one row: the node that is alone on its level
    top = above.where("size = 1").unionByName(tops.where("size = 1").withColumn("level", F.lit(0))).select("hash").first()

    # nodes whose siblings lie in several leaf partitions; a node of level v stands for FAN ** v leaves
    def shared(nodes: DataFrame) -> DataFrame:
        width = F.pow(F.lit(FAN), F.col("level") + 1).cast("bigint")
        low = F.col("start") + F.floor(F.col("pos") / FAN) * width
        high = F.least(low + width, F.col("start") + F.col("leaves")) - 1
        return nodes.where(F.floor(low / PART) != F.floor(high / PART)).select("tree", "level", "pos", "hash")
    inner = interior.where("size > 1").select("tree", "level", "pos", "hash").join(
        trees.select("tree", "start", F.col("size").alias("leaves")), "tree")
    outer = placed.select("tree", F.lit(0).alias("level"), "pos", "hash", "start", F.col("size").alias("leaves"))
    nodes = shared(outer).unionByName(shared(inner)) \
        .unionByName(tops.select("tree", F.lit(0).alias("level"), "pos", "hash")).unionByName(above.select("tree", "level", "pos", "hash"))

    runs = placed.groupBy("part", "tree").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.min("size").alias("size"))
    over = placed.groupBy("part").agg(F.min("tree").alias("lo"), F.max("tree").alias("hi")).select(
        "part", F.lit(TOP).cast("bigint").alias("tree"), "lo", "hi", F.lit(count).cast("bigint").alias("size"))
    wanted = runs.unionByName(over).mapInArrow(_coordinates, "part bigint, tree bigint, level int, pos bigint")
    fetched = wanted.join(nodes, ["tree", "level", "pos"])
    key = placed.schema["_key"].dataType.simpleString()
    out = placed.repartition(n, "part").groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(
        _expanded(count), f"_key {key}, leaf string, subroot string, derived_root string, proof_sha256 string, folded_root string")
    root = F.lit(bytes(top["hash"]).decode() if top else None).cast("string")
    return out.select("_key", "leaf", "subroot", root.alias("root"), "derived_root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == root).alias("verified"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    other = leaf_of(*[F.translate("text", capitals, capitals.lower()) if c == "text" else F.col(c) for c in COLUMNS])
    return manifest(docs, "source", "doc_id", leaf_of(*map(F.col, COLUMNS)), F.when(id_mod(TAMPERED) == 0, other)) \
        .select("_key.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _oracle(depth: int = 4, tops: int = 3) -> str:
    """One statement with ``depth`` levels for each source and ``tops`` over the sources.

    On every level each leaf's row has its run (the nodes joined, 64 characters each) and its place in it; a level of one
    node only repeats it.
    """
    def level(k: int, by: str) -> str:
        return f"""
n{k} AS (SELECT DISTINCT {by} k, p, h FROM l{k}),
r{k} AS (SELECT k, p // 16 AS q, string_agg(h, '' ORDER BY p) AS run, sum(count(*)) OVER (PARTITION BY k) AS size FROM n{k} GROUP BY k, p // 16),
l{k + 1} AS (
  SELECT doc_id, source, leaf, subroot, l.p // 16 AS p, CASE WHEN size = 1 THEN h ELSE sha256(run) END AS h,
         CASE WHEN size = 1 THEN proof ELSE proof || substr(run, 1, 64 * (l.p % 16)) || substr(run, 64 * (l.p % 16) + 65) END AS proof,
         CASE WHEN size = 1 THEN fold ELSE sha256(substr(run, 1, 64 * (l.p % 16)) || fold || substr(run, 64 * (l.p % 16) + 65)) END AS fold
  FROM l{k} l JOIN r{k} r ON r.k IS NOT DISTINCT FROM {'l.source' if by == 'source AS' else '1'} AND r.q = l.p // 16),"""

    def text(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    body = " || ".join(map(text, COLUMNS))
    low = body.replace(text("text"), text("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))
    return f"""
WITH c AS (
  SELECT *, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ord(x)::BIGINT)),
    lambda s, x: list_reduce(list_concat([xor(s, x)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda r, z: xor(r >> 1, 3988292384 * (r & 1))))) % 5 = 0 AS low
  FROM documents),
l0 AS (
  SELECT doc_id, source, sha256({body}) AS leaf, NULL::VARCHAR AS subroot,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS p, sha256({body}) AS h, '' AS proof,
         sha256(CASE WHEN low THEN {low} ELSE {body} END) AS fold FROM c),
{''.join(level(k, 'source AS') for k in range(depth))}
l{depth + 1} AS (
  SELECT doc_id, source, leaf, h AS subroot, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS p, h, proof, fold FROM l{depth}),
{''.join(level(k, '1 AS') for k in range(depth + 1, depth + 1 + tops))}
z AS (SELECT *, h AS root FROM l{depth + 1 + tops})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified FROM z
"""


ORACLE = _oracle()
