"""Near duplicates by DartMinHash signatures, banded joining and exact verification.

A text is a weighted set of 5-word shingles (``weights="set"``: weight 1 each, so that similarity is the Jaccard
similarity of the contract; ``"count"``: weight = occurrences, weighted Jaccard).  Every element owns an endless plane
of weight by rank, on which darts fall by a Poisson process that depends on the element's hash alone.  A text throws
only the darts that can matter: those inside its elements' weights and below the rank ``t / total weight``, about
``t = K ln K + 2K`` of them whatever its length.  Each dart falls on one of K coordinates; the earliest one of a
coordinate is its entry.  Texts with a coordinate left empty go on to twice the rank.

1. Texts with equal element sets form one node (copies are collapsed before any join).
2. Bands of ``ROWS`` coordinates give buckets.  Pairs in a bucket are never all emitted: each member is compared with
   the bucket's pivot (first the one with the most bucket mates, then the like of those still apart), and only while
   they are not known to be connected.  After ``PIVOTS`` rounds all pairs between components that can still be links
   are found by what they share outside of the pivot's set (``_left_over``), so that no link is passed over.
3. A pair is dropped early only if its sizes rule the similarity out, or if four bits of each coordinate differ in
   more places than a similar pair does (probability 3e-7).  All others are verified on the exact sets.
4. Components by smallest label, with every round written to the shared folder.

With 32 bands of 5, a pair at similarity 0.8 exactly misses all buckets with probability 3e-6.

Defined cases: null = empty text = no words = never a duplicate; texts of one to four words have one shingle, all of
their words; repeated rows are copies; a null id sorts first; extra columns pass through; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, saved, small_batches, table, text_of
from .textarrays import NOT_SPACE, U64, Block, blocks, mix, window_hash

SHINGLE = 5
BANDS, ROWS = 32, 5
K = BANDS * ROWS
SIMILARITY_PCT = 80
PIVOTS = 2
#: Bits kept of each coordinate, and in how many coordinates a pair may differ by them: at similarity 0.8 it differs
#: in 30 of 160 on average, in more than 56 with a probability of 3e-7.
PLANES = 4
MAX_DIFFER = 56
BITMAP_BITS = 22
C1, C2, C3 = U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB), U64(0x8EBC6AF09C88C6E3)


def elements(b: Block, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, element, count) of a block's shingles, sorted by row, then element."""
    n = np.diff(b.first)
    rows, values = [], []
    for size in range(1, SHINGLE + 1):
        place, x = window_hash(h, b.row, size)
        r = b.row[place]
        take = n[r] >= size if size == SHINGLE else n[r] == size
        rows.append(r[take])
        values.append(x[take])
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return row[at], value[at], np.diff(np.append(at, len(row)))


def darts(row: np.ndarray, value: np.ndarray, weight: np.ndarray, n_rows: int, k: int = K) -> np.ndarray:
    """The entries of every row's k coordinates; rows without elements keep zeros.

    A plane is cut into strips of weight [2**v - 1, 2**(v+1) - 1): a strip's darts arrive in rank order at rate 2**v.
    """
    out = np.zeros((n_rows, k), U64)
    total = np.bincount(row, weights=weight, minlength=n_rows)
    t = k * np.log(k) + 2 * k
    strip_of, v = [], 0
    while True:
        at = np.flatnonzero(weight > 2.0**v - 1)
        if not len(at):
            break
        strip_of.append((at, np.full(len(at), v)))
        v += 1
    if not strip_of:
        return out
    at, level = (np.concatenate(x) for x in zip(*strip_of))
    todo = np.flatnonzero(total > 0)
    reach = 1.0
    while len(todo):
        limit = np.zeros(n_rows)
        limit[todo] = reach * t / total[todo]
        use = limit[row[at]] > 0
        el, lv = at[use], level[use]
        seed = mix(value[el] + lv.astype(U64) * C1)
        rank = np.zeros(len(el))
        best = np.full(n_rows * k, np.inf)
        entry = np.zeros(n_rows * k, U64)
        j = 0
        thrown = []
        while len(el):
            j += 1
            x = mix(seed + U64((j * int(C2)) & (2**64 - 1)))
            rank = rank - np.log1p(-(x >> U64(11)).astype(np.float64) * 2.0**-53) / 2.0**lv
            live = rank < limit[row[el]]
            el, lv, seed, rank, x = el[live], lv[live], seed[live], rank[live], x[live]
            y = mix(x ^ C3)
            inside = ((mix(y + C1) >> U64(11)).astype(np.float64) * 2.0**-53 + 1) * 2.0**lv - 1 < weight[el]
            thrown.append((row[el][inside] * k + (y[inside] % U64(k)).astype(np.int64), rank[inside], y[inside]))
        if thrown:
            cell, when, what = (np.concatenate(x) for x in zip(*thrown))
            np.minimum.at(best, cell, when)
            first = when == best[cell]
            entry[cell[first]] = what[first]
        full = np.isfinite(best).reshape(n_rows, k).all(axis=1)
        done = todo[full[todo]]
        out[done] = entry.reshape(n_rows, k)[done]
        todo = todo[~full[todo]]
        reach *= 2
    return out


def set_ids(row: np.ndarray, value: np.ndarray, count: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit identity of every row's weighted set: two sums of mixed elements."""
    out = []
    for c in (C1, C2):
        s = np.zeros(n_rows, U64)
        np.add.at(s, row, mix((value ^ c) + count.astype(U64) * C3))
        out.append(s.view(np.int64))
    return out[0], out[1]


def _weighted(b: Block, weights: str):
    row, value, count = elements(b, b.hashes())
    return row, value, (np.ones_like(count) if weights == "set" else count)


def _signatures(weights: str):
    def run(batches):
        for b in blocks(batches):
            n = b.rows.num_rows
            row, value, weight = _weighted(b, weights)
            sig = darts(row, value, weight.astype(np.float64), n)
            band = np.full((n, BANDS), 0, U64) + np.arange(BANDS, dtype=U64)
            for i in range(ROWS):
                band = mix(band * C3 + sig[:, i::ROWS])
            # word after word, the planes of a word side by side
            planes = [np.packbits(((sig >> U64(63 - p)) & U64(1)).astype(bool), axis=1) for p in range(PLANES)]
            words = [np.ascontiguousarray(np.pad(p, ((0, 0), (0, -p.shape[1] % 8)))).view(np.int64) for p in planes]
            bits = np.stack(words, axis=2).reshape(n, -1)
            s1, s2 = set_ids(row, value, weight, n)
            total = np.bincount(row, weights=weight, minlength=n).astype(np.int64)
            lists = lambda a: pa.ListArray.from_arrays(
                np.arange(0, a.size + 1, a.shape[1], dtype=np.int32), pa.array(a.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.rows.column("_doc"), b.rows.column("_key"), pa.array(s1), pa.array(s2), pa.array(total),
                 lists(band.view(np.int64)), lists(bits)],
                names=["_doc", "_key", "s1", "s2", "n", "bands", "bits"])
    return run


def _sets(weights: str, bitmap):
    def run(batches):
        for b in blocks(batches):
            row, value, weight = _weighted(b, weights)
            s1, s2 = set_ids(row, value, weight, b.rows.num_rows)
            low = s1.view(U64) & U64((1 << BITMAP_BITS) - 1)
            wanted = (bitmap.value[(low >> U64(6)).astype(np.int64)] >> (low & U64(63))) & U64(1) != 0
            # weight w stands for w elements: the element itself, and w - 1 hashes of it
            many = np.repeat(np.arange(len(row)), weight)
            turn = np.arange(len(many)) - np.repeat(np.cumsum(weight) - weight, weight)
            row, value = row[many], np.where(turn == 0, value[many], mix(value[many] + turn.astype(U64) * C2))
            take = wanted[row]
            size = np.bincount(row[take], minlength=b.rows.num_rows)[wanted]
            yield pa.RecordBatch.from_arrays(
                [pa.array(s1[wanted]), pa.array(s2[wanted]), pa.ListArray.from_arrays(
                    np.concatenate([[0], np.cumsum(size)]).astype(np.int32), pa.array(value[take].view(np.int64)))],
                names=["s1", "s2", "e"])
    return run


def _similar_enough(a: str, b: str) -> Column:
    """What a similar pair must satisfy: sizes within the ratio, and few coordinates that differ."""
    def word(i):
        planes = [F.col(f"{a}.bits")[i * PLANES + p].bitwiseXOR(F.col(f"{b}.bits")[i * PLANES + p]) for p in range(PLANES)]
        return F.bit_count(reduce(Column.bitwiseOR, planes))
    differ = reduce(Column.__add__, [word(i) for i in range((K + 63) // 64)])
    lo, hi = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (lo * 100 >= hi * SIMILARITY_PCT) & (differ <= MAX_DIFFER)


def components(edges: DataFrame) -> DataFrame:
    """(v, label): the smallest node of each connected component, for the nodes of ``edges`` (a, b).

    Every round takes the least label of the neighbours and then the label's own label; rounds are written.
    """
    both = saved(edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select("b", "a")), "cc-edges")
    labels = saved(both.groupBy("v").agg(F.least(F.min("w"), F.first("v")).alias("label")), "cc-labels")
    last = None
    while True:
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)")).alias("s")).first()["s"]
        if total is None or total == last:
            return labels
        last = total
        near = both.join(labels.withColumnRenamed("v", "w"), "w").select("v", "label")
        step = saved(near.union(labels).groupBy("v").agg(F.min("label").alias("label")), "cc-step")
        up = step.select(F.col("v").alias("label"), F.col("label").alias("up"))
        labels = saved(step.join(up, "label", "left").select("v", F.coalesce("up", "label").alias("label")), "cc-labels")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""
    left = pairs.join(sets.select(F.col("v").alias("a"), F.col("e").alias("ea")), "a")
    both = left.join(sets.select(F.col("v").alias("b"), F.col("e").alias("eb")), "b")
    common = F.size(F.array_intersect("ea", "eb"))
    union = F.size("ea") + F.size("eb") - common
    return both.where(common.cast("long") * 100 >= union.cast("long") * SIMILARITY_PCT).select("a", "b")


def _left_over(x: DataFrame, apart: DataFrame, central: DataFrame, sets: DataFrame) -> DataFrame:
    """(v, w): all pairs that may still be links, of a member apart from its bucket's central one, h, and any other.

    What two texts share lies outside of h's set, or they share at most m = min(|v & h|, |w & h|), which bounds the
    similarity by m / (|v| + |w| - m).  So the pairs that share an element outside of h are joined by that element,
    and of the others only those are kept that the bound allows.
    """
    hubs = central.withColumnRenamed("v", "hub")
    mates = x.join(hubs.join(apart.select("key").distinct(), "key"), "key").select("v", "n", "bits", "label", "hub").distinct()
    beside = mates.join(sets, "v").join(sets.select(F.col("v").alias("hub"), F.col("e").alias("eh")), "hub") \
        .select("v", "n", "bits", "label", "hub", F.array_except("e", "eh").alias("outside"))
    beside = saved(beside.withColumn("inside", F.col("n") - F.size("outside")), "near-beside")
    rest = saved(beside.join(apart.join(hubs, "key").select("v", "hub").distinct(), ["v", "hub"], "left_semi"), "near-rest")
    other = (F.col("r.label") != F.col("x.label")) & _similar_enough("r", "x")
    each = lambda d: d.withColumn("element", F.explode("outside")).drop("outside")
    by_element = each(rest).alias("r").join(each(beside).alias("x"), ["hub", "element"]).where(other)
    m = F.least("r.inside", "x.inside")
    by_bound = rest.drop("outside").alias("r").join(beside.drop("outside").alias("x"), "hub").where(
        (m * 100 >= (F.col("r.n") + F.col("x.n") - m) * SIMILARITY_PCT) & other)
    both = [d.select(F.col("r.v").alias("v"), F.col("x.v").alias("w")) for d in (by_element, by_bound)]
    return both[0].union(both[1])


def _links(nodes: DataFrame, sets: DataFrame, multi: DataFrame) -> DataFrame:
    """(v, label) of the nodes that are linked to others."""
    spark = nodes.sparkSession
    labels = spark.createDataFrame([], "v bigint, label bigint")
    tested = spark.createDataFrame([], "a bigint, b bigint")
    central = None
    for turn in range(PIVOTS + 1):
        # a bucket of two is settled by its pivot
        x = (multi if turn == 0 else multi.where("c > 2")).join(labels, "v", "left")
        x = saved(x.withColumn("label", F.coalesce("label", "v")), "near-members")
        best = F.max(F.struct("degree", "v")).alias("p")
        if turn == 0:
            central = pivot = saved(x.groupBy("key").agg(best).select("key", F.col("p.v").alias("v")), "near-pivots")
            apart = x.alias("x")
        else:  # members apart from the central one; of them the next pivot
            main = saved(central.join(x.select("key", "v", F.col("label").alias("main")), ["key", "v"]).select("key", "main"), "near-main")
            apart = saved(x.join(main, "key").where("label <> main").drop("main"), "near-apart")
            if apart.isEmpty():
                return labels
            pivot = saved(apart.groupBy("key").agg(best).select("key", F.col("p.v").alias("v")), "near-pivots")
        if turn < PIVOTS:
            held = saved(pivot.join(x, ["key", "v"]), "near-pivots")
            pairs = x.alias("x").join(held.alias("p"), "key").where(
                (F.col("x.label") != F.col("p.label")) & _similar_enough("x", "p")) \
                .select(F.col("x.v").alias("v"), F.col("p.v").alias("w"))
        else:
            pairs = _left_over(x, apart, central, sets)
        pairs = pairs.select(F.least("v", "w").alias("a"), F.greatest("v", "w").alias("b")).distinct()
        pairs = saved(pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        tested = tested.union(pairs)
        edges = saved(_verified(pairs, sets), "near-edges")
        # only components are joined: an edge between them, by their labels
        named = labels.select("v", "label")
        e = edges.join(named.withColumnRenamed("v", "a").withColumnRenamed("label", "la"), "a", "left") \
            .join(named.withColumnRenamed("v", "b").withColumnRenamed("label", "lb"), "b", "left") \
            .select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))
        e = saved(e, "near-edges")
        up = components(e.select(F.col("la").alias("a"), F.col("lb").alias("b")))
        up = up.select(F.col("v").alias("label"), F.col("label").alias("up"))
        known = labels.union(e.select("a", "la")).union(e.select("b", "lb")).distinct()
        labels = saved(known.join(up, "label", "left").select("v", F.coalesce("up", "label").alias("label")), "near-labels")
    return labels


def classes(docs: DataFrame, carry: list[str], weights: str = "set") -> DataFrame:
    """Per row: ``_doc`` (its ``carry`` columns), ``_key``, ``n`` (total weight), ``class_id``, ``rows_in_class``,
    ``kept`` (one row of a class: the smallest ``carry`` values, then any one of equal rows).

    ``docs`` needs ``text`` and ``doc_id``; ``_key`` names a row's id and text.  A class id is the smallest doc_id.
    """
    spark = docs.sparkSession
    small_batches(spark)
    keyed = docs.select(F.struct(*carry).alias("_doc"), row_key(docs).alias("_key"), text_of("text").alias("_t"))
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    kind = T.StructType([keyed.schema["_doc"], keyed.schema["_key"]]).add("s1", long).add("s2", long).add("n", long) \
        .add("bands", longs).add("bits", longs)
    seen = saved(keyed.mapInArrow(_signatures(weights), kind).withColumn("_row", F.monotonically_increasing_id()), "near-docs")
    nodes = saved(seen.where("n > 0").groupBy("s1", "s2", "n").agg(
        F.min("_row").alias("v"), F.first("bands").alias("bands"), F.first("bits").alias("bits")), "near-nodes")
    entries = nodes.select("v", F.explode("bands").alias("key"))
    shared = saved(entries.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "near-buckets")
    met = saved(entries.join(shared, "key"), "near-met")
    # how many bucket mates a node has: the text that many others were made from has the most
    degree = met.groupBy("v").agg(F.sum("c").alias("degree"))
    multi = saved(met.join(nodes.select("v", "n", "bits").join(degree, "v"), "v"), "near-multi")
    wanted = nodes.join(multi.select("v").distinct(), "v", "left_semi").select("v", "s1", "s2")
    wanted = saved(wanted, "near-wanted")
    low = F.col("s1").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    rows = wanted.select(F.shiftright(low, 6).alias("word"), F.expr("shiftleft(1L, cast(s1 & 63 as int))").alias("bit")) \
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most 2**(BITMAP_BITS - 6) rows
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    bitmap[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    sets = docs.select(text_of("text").alias("_t")).mapInArrow(
        _sets(weights, spark.sparkContext.broadcast(bitmap.view(U64))), "s1 bigint, s2 bigint, e array<bigint>") \
        .groupBy("s1", "s2").agg(F.first("e").alias("e"))
    sets = saved(wanted.join(sets, ["s1", "s2"]).select("v", "e"), "near-sets")
    labels = _links(nodes, sets, multi)
    node_of = nodes.select("s1", "s2", "n", "v").join(labels, "v", "left") \
        .select("s1", "s2", "n", F.coalesce("label", "v").alias("label"))
    placed = seen.select("_doc", "_key", "_row", "s1", "s2", "n").join(saved(node_of, "near-classes"), ["s1", "s2", "n"], "left")
    placed = saved(placed.withColumn("label", F.coalesce("label", "_row"))
                   .select("_doc", "_key", "_row", "n", "label", F.col("_doc.doc_id").alias("_id")), "near-placed")
    heads = placed.groupBy("label").agg(F.min("_id").alias("class_id"), F.count("*").alias("rows_in_class"),
                                        F.min(F.struct("_id", "_row"))["_row"].alias("_head"))
    return placed.join(saved(heads, "near-heads"), "label").select(
        "_doc", "_key", "n", "class_id", "rows_in_class", (F.col("_row") == F.col("_head")).alias("kept"))


def row_key(docs: DataFrame) -> Column:
    """md5 of a row's text and id."""
    return F.md5(F.concat(F.md5(text_of("text").cast("binary")), F.lit(":"),
                          F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of every class, all columns kept."""
    from pyspark.sql import Window
    kept = saved(classes(docs, ["doc_id"], **options).where("kept").select("_key").distinct(), "near-kept")
    rows = packed(docs).select("_doc", F.md5(F.concat(
        F.md5(F.col("_t").cast("binary")), F.lit(":"), F.coalesce(F.col("_doc.doc_id").cast("string"), F.lit("null")))
        .cast("binary")).alias("_key"))
    # equal rows share a key; one of them stays
    turn = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    return rows.join(kept, "_key", "left_semi").withColumn("_turn", turn).where("_turn = 1").select("_doc.*")


def op2_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("_doc.doc_id", "class_id", "rows_in_class", "kept", F.col("n").alias("n_shingles"))
