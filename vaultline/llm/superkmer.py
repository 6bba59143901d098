"""Substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words.  Its minimiser is the least of its word pairs in a fixed random order, with
the pairs that fill more than 1/``HEAVY`` of the corpus last: windows around a very common passage then go by the
words next to it and do not meet in one place.  Consecutive windows with one minimiser travel as one packed string
(a super-k-mer) to the minimiser's bucket, where the windows are sorted and equal ones found, word for word.  A
window is repeated if an equal one starts earlier (smaller doc_id, or same document and earlier start); every word of
a repeated window is removed.

* The order only deals work out: whatever it is, equal windows have equal minimisers and meet.
* A task passes a packed string on only if it has not met it at an earlier place; later places are known to be
  repeated at once.  So a passage that millions of documents share reaches its bucket once from each task.
* Of a packed string's places only the first is compared with others; all later ones are repeated as a whole.
* Packed strings travel by groups of buckets, compressed together: they overlap by a window less a word.
* A minimiser's windows, at most 1/``HEAVY`` of all, are dealt to as many buckets as keep them below about ``BUCKET``
  windows, by a second minimiser over word triples.
* What tasks get of the corpus's counts is a bitmap of ``2 ** CELL_BITS`` bits.

Defined cases: null = empty text = no words; a text of fewer than ``WINDOW`` words loses nothing; a null id is the
smallest; rows with one id are documents of their own, in the order of their texts' hashes; rows equal in id and text
are one document that stands there several times, and are judged alike; extra columns pass through; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved, small_batches, table, text_of
from .textarrays import NOT_SPACE, SEGMENT, U64, _powers, blocks, mix, words_of

WINDOW = 20
CELL_BITS = 20
HEAVY = 1 << 13
#: Windows in one packed string at most, and packed strings that a task remembers at a time.
LONGEST = 256
REMEMBERED = 1 << 18
#: Windows of a bucket, about.
BUCKET = 1 << 22
#: Bytes of packed strings that a task holds before it passes them on; groups of buckets for each shuffle partition.
HELD = 24 << 20
GROUPS = 8
NO_ID = -(1 << 63)
PACKED = pa.schema([("grp", pa.int32()), ("known", pa.bool_()), ("blob", pa.binary())])
RANGES = pa.schema([("id", pa.int64()), ("sub", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])


def _pairs(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word with its next one, and whether both are of one row."""
    x = mix(h[:-1] * U64(0xC2B2AE3D27D4EB4F) + h[1:])
    return x, row[1:] == row[:-1]


def _cells(batches):
    """Counts of the pairs' cells that are heavy in this task, and the number of pairs as cell -1.

    A cell above 1/HEAVY of all pairs is above 1/(2 HEAVY) in tasks that hold half of its count at least.
    """
    count, n = np.zeros(1 << CELL_BITS, np.int64), 0
    for b in blocks(batches):
        if len(b.start) > 1:
            x, same = _pairs(b.hashes(), b.row)
            cells = (x[same] >> U64(64 - CELL_BITS)).astype(np.int64)
            n += len(cells)
            count += np.bincount(cells, minlength=len(count))
    heavy = np.flatnonzero(count * 2 * HEAVY > n)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(heavy, -1)), pa.array(np.append(count[heavy], n))],
                                     names=["cell", "n"])


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive values, by doubling."""
    width = 1
    while width * 2 <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:len(x) - (size - width)], x[size - width:]) if size > width else x


def _blob(*parts) -> bytes:
    """Arrays and bytes, each with its length before it, compressed."""
    raw = [p if isinstance(p, bytes) else np.ascontiguousarray(p).tobytes() for p in parts]
    return zstandard.compress(b"".join(x for p in raw for x in (len(p).to_bytes(8, "little"), p)), 1)


def _unblob(blob: bytes) -> list[bytes]:
    raw, out, at = zstandard.decompress(blob), [], 0
    while at < len(raw):
        n = int.from_bytes(raw[at:at + 8], "little")
        out.append(raw[at + 8:at + 8 + n])
        at += 8 + n
    return out


def _passed_on(packs: list[tuple], known: list, groups: int) -> pa.RecordBatch:
    """A row for each group of buckets with its packed strings, and one with the ranges known to be repeated."""
    rows = []
    if packs:
        key, ids, subs, start, length = (np.array([p[i] for p in packs], t) for i, t in (
            (0, U64), (2, np.int64), (3, np.int64), (4, np.int32), (5, np.int32)))
        group = (key % U64(groups)).astype(np.int32)
        order = np.lexsort((key, group))
        edge = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1))
        for i, j in zip(edge[:-1], edge[1:]):
            own = order[i:j]
            rows.append((int(group[own[0]]), False, _blob(ids[own], subs[own], start[own], length[own], b"".join([packs[k][1] for k in own]))))
    if known:
        ids, subs, a, e = (np.array(c, t) for c, t in zip(zip(*known), (np.int64, np.int64, np.int32, np.int32)))
        rows.append((int(ids[0] % groups), True, _blob(ids, subs, a, e)))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(PACKED)], schema=PACKED)


def _packs(heavy, window: int, groups: int, deal: int):
    def run(batches):
        met: dict[bytes, tuple[int, int, int]] = {}
        out: list[tuple] = []
        known: list[list[int]] = []
        held = 0
        for b in blocks(batches):
            n = len(b.start)
            if n < window:
                continue
            x, same = _pairs(b.hashes(), b.row)
            order = (x >> U64(1)) | (heavy.value[(x >> U64(64 - CELL_BITS)).astype(np.int64)].astype(U64) << U64(63))
            order[~same] = ~U64(0)
            least = _least(order, window - 1)
            good = np.flatnonzero(b.row[:n - window + 1] == b.row[window - 1:])  # windows within one row
            if not len(good):
                continue
            value, row = least[good], b.row[good]
            if deal > 1:
                triples = mix(x[:-1] * U64(0xFF51AFD7ED558CCD) + x[1:])  # least over those of each window
                value = mix(value + _least(triples, window - 2)[good] % U64(deal))
            new = np.ones(len(good), bool)
            new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
            at = np.flatnonzero(new)
            runs = np.diff(np.append(at, len(good)))
            if runs.max() > LONGEST:  # long runs in pieces
                pieces = -(-runs // LONGEST)
                turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = np.repeat(at, pieces) + turn * LONGEST
                runs = np.minimum(np.repeat(at + runs, pieces) - start, LONGEST)
                at = start
            joined, place = b.joined()
            first = good[at]
            ids, subs = (np.asarray(b.rows.column(c))[b.row[first]].tolist() for c in ("id", "sub"))
            offset = first - b.first[b.row[first]]
            lo, hi = place[first].tolist(), (place[first + runs + window - 1] - 1).tolist()
            for k, i, j, d, s, a, w in zip(mix(value[at]).tolist(), lo, hi, ids, subs, offset.tolist(), (runs + window - 1).tolist()):
                pack = joined[i:j]
                name = xxhash.xxh3_128_digest(pack)
                before = met.get(name)
                if before is None or (d, s, a) <= before:
                    met[name] = (d, s, a)
                    out.append((k, pack, d, s, a, j - i))
                    held += j - i
                elif known and known[-1][:2] == [d, s] and known[-1][2] <= a <= known[-1][3]:
                    known[-1][3] = max(known[-1][3], a + w)
                else:
                    known.append([d, s, a, a + w])
            if len(met) > REMEMBERED:
                met.clear()
            if held > HELD or len(known) > REMEMBERED:
                yield _passed_on(out, known, groups)
                out, known, held = [], [], 0
        yield _passed_on(out, known, groups)
    return run


def _repeated(packs: list[bytes], places: list[tuple[int, int, int]], window: int) -> list[tuple[int, int, int, int]]:
    """Ranges of words in repeated windows, for packed strings with whole buckets among them."""
    first: dict[bytes, tuple[int, int, int]] = {}
    for p, at in zip(packs, places):
        if p not in first or at < first[p]:
            first[p] = at
    own = list(first)
    b = words_of(None, pa.array(own, pa.binary()).cast(pa.large_binary()).cast(pa.large_string()), NOT_SPACE, False)
    n = dict(zip(own, np.diff(b.first).tolist()))
    out = [(*at, at[2] + n[p]) for p, at in zip(packs, places) if first[p] < at]
    h = b.hashes()
    up, down = _powers()
    hashes, where = [], []
    for i in range(0, len(h), SEGMENT - window):  # sums of hashes times powers, in stretches that overlap by a window
        part = h[i:i + SEGMENT]
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(part * up[:len(part)], dtype=U64)])
        m = min(len(part) - window + 1, SEGMENT - window)
        if m > 0:
            hashes.append((sums[window:window + m] - sums[:m]) * down[:m])
            where.append(np.arange(i, i + m))
    if not hashes:
        return out
    value, place = np.concatenate(hashes), np.concatenate(where)
    ok = b.row[place] == b.row[place + window - 1]
    value, place = value[ok], place[ok]
    order = np.argsort(value, kind="stable")
    value, place = value[order], place[order]
    twin = np.zeros(len(value), bool)
    twin[1:] = value[1:] == value[:-1]
    twin[:-1] |= twin[1:]
    value, place = value[twin], place[twin]
    row = b.row[place]
    begin = np.array([first[p] for p in own], np.int64).reshape(-1, 3)
    doc, sub, start = begin[row, 0], begin[row, 1], begin[row, 2] + place - b.first[row]
    order = np.lexsort((start, sub, doc, value))
    last, met = None, {}
    again: list[tuple[int, int, int]] = []
    for v, p, *at in zip(*(x[order].tolist() for x in (value, place, doc, sub, start))):
        if v != last:
            last, met = v, {}
        words = b.words(p, p + window)  # words in a packed string stand one space apart
        if words not in met:
            met[words] = at
        elif met[words] < at:
            again.append(tuple(at))
    for d, u, s in sorted(again):
        if out and out[-1][:2] == (d, u) and out[-1][2] <= s <= out[-1][3]:
            out[-1] = (d, u, out[-1][2], max(out[-1][3], s + window))
        else:
            out.append((d, u, s, s + window))
    return out


def _buckets(window: int):
    """Rows come sorted by group; a group is worked on as a whole."""
    def ranges(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RANGES)], schema=RANGES)

    def found(packs, places):
        return ranges(list(zip(*_repeated(packs, places, window))) or [[], [], [], []])

    def run(batches):
        packs, places, last = [], [], None
        for batch in batches:
            for group, known, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                parts = _unblob(blob)
                if known:
                    yield ranges([np.frombuffer(p, t) for p, t in zip(parts, (np.int64, np.int64, np.int32, np.int32))])
                    continue
                if group != last and packs:
                    yield found(packs, places)
                    packs, places = [], []
                last = group
                places += zip(*(np.frombuffer(p, t).tolist() for p, t in zip(parts, (np.int64, np.int64, np.int32))))
                at = np.concatenate([[0], np.cumsum(np.frombuffer(parts[3], np.int32), dtype=np.int64)]).tolist()
                packs += [parts[4][i:j] for i, j in zip(at[:-1], at[1:])]
        if packs:
            yield found(packs, places)
    return run


def _kept(batches):
    for b in blocks(batches):
        gone = np.zeros(len(b.start) + 1, np.int64)
        spans = b.rows.column("ranges").to_pylist()
        for r, found in enumerate(spans):
            for x in found or ():
                if b.first[r] + x["b"] > b.first[r + 1]:
                    raise ValueError("a repeated window reaches beyond its text")
                gone[b.first[r] + x["a"]] += 1
                gone[b.first[r] + x["b"]] -= 1
        stay = np.cumsum(gone[:-1]) == 0
        joined, at = b.joined()
        text, n, removed = [], [], []
        for r in range(b.rows.num_rows):
            lo, hi = int(b.first[r]), int(b.first[r + 1])
            n.append(hi - lo)
            here = stay[lo:hi]
            removed.append(int((~here).sum()))
            if removed[-1] == 0:
                text.append(joined[at[lo]:at[hi] - 1] if hi > lo else b"")
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[0], here.astype(np.int8), [0]]))) + lo  # stretches that stay
            text.append(b" ".join(joined[at[i]:at[j] - 1] for i, j in edge.reshape(-1, 2)))
        yield pa.RecordBatch.from_arrays(
            [b.rows.column("_doc"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(text, pa.binary()).cast(pa.string())], names=["_doc", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, carry: list[str], window: int = WINDOW) -> DataFrame:
    """Per row: ``_doc`` (its ``carry`` columns), n_words, n_removed, ``kept`` (the other words, one space between).

    ``docs`` needs an integer ``doc_id`` and ``text``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    # texts tell rows of one id apart; without such rows nothing more than the id travels
    shared = not docs.groupBy(ident).count().where("count > 1").isEmpty()
    sub = F.xxhash64(text_of("text")) if shared else F.lit(0).cast("long")
    rows = docs.select(F.struct(*carry).alias("_doc"), ident.alias("id"), sub.alias("sub"), text_of("text").alias("_t"))
    cells = rows.select("_t").mapInArrow(_cells, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = saved(cells, "kmer-cells")
    n = cells.where("cell = -1").agg(F.sum("n")).first()[0] or 0
    # at most 2 * HEAVY cells
    heavy = [r["cell"] for r in cells.where((F.col("cell") >= 0) & (F.col("n") * 2 * HEAVY > n)).select("cell").collect()]
    bitmap = np.zeros(1 << CELL_BITS, bool)
    bitmap[heavy] = True
    groups = GROUPS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    deal = -(-n // (HEAVY * BUCKET))
    packs = rows.select("id", "sub", "_t").mapInArrow(
        _packs(spark.sparkContext.broadcast(bitmap), window, groups, deal), "grp int, known boolean, blob binary")
    ranges = packs.repartition("grp").sortWithinPartitions("grp").mapInArrow(_buckets(window), "id bigint, sub bigint, a int, b int")
    by_doc = ranges.groupBy("id", "sub").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    kind = T.StructType([rows.schema["_doc"]]).add("n_words", T.LongType()).add("n_removed", T.LongType()).add("kept", T.StringType())
    return rows.join(by_doc, ["id", "sub"], "left").select("_doc", "_t", "ranges").mapInArrow(_kept, kind)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "_doc.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p, w[p + 1:p + 20] AS words FROM d, unnest(range(0, greatest(len(w) - 19, 0))) AS u(p)),
again AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY words ORDER BY doc_id, p) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, p + j AS p FROM again, unnest(range(0, 20)) AS u(j)),
word AS (
  SELECT d.doc_id, p, w[p + 1] AS word FROM d, unnest(range(0, len(w))) AS u(p)),
kept AS (
  SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.p) AS kept, count(*) AS n
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p WHERE gone.p IS NULL GROUP BY word.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
