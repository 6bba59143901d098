"""Language-model scores: an interpolated modified Kneser-Ney bigram model.

Counting is one Spark job.  Tasks combine the word pairs they meet and pass them on, packed, to a grid of shards (row
by the first word, column by the second): a very common word is spread over a whole row or column.  A shard merges
its pairs, writes them as a sorted array of hashes with counts, and passes on what it knows about each word; a
second deal by word gives the vocabulary, written the same way.  Three sums (counts of counts) reach the driver.

Scoring is one scan: a task maps the arrays into memory (the operating system keeps one copy per machine) and looks
up each block's distinct words and pairs.

P(w|v) = max(c(vw) - D, 0)/c(v) + g(v) P1(w), P1(w) = max(N(w) - D', 0)/N + g' / (V + 1): N(w) counts the distinct words
before w, D depends on the count (1, 2, 3 and more) and is estimated from the counts of counts.  A word that is not in
the training texts gets P1's last part; the model sums to one over the V words and one unknown.

The model has order 2: the pairs of a corpus and their shards fit the disk budget, its triples do not (README).

Defined cases: null = empty text: its one token is the end; repeated rows count as often as they stand; a null id
counts as the empty text for the fold; extra columns pass through; an empty table gives an empty result; without any
training text the model knows no word and gives every token probability one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_dir
from .common import id_mod, small_batches, table, text_of
from .files import mapped, names, put
from .textarrays import NOT_SPACE, U64, blocks, mix

BEGIN, END = U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)
#: Pairs that a task holds before it passes them on.
FLUSH = 3_000_000
FOLDS = 10


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * U64(0xC2B2AE3D27D4EB4F) + w)


def pairs_of(b, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, v, w) of all tokens of a block: its words, then each row's end."""
    n = b.rows.num_rows
    v, w = np.empty(len(h) + n, U64), np.empty(len(h) + n, U64)
    row = np.repeat(np.arange(n), np.diff(b.first) + 1)
    at = np.arange(len(h)) + b.row
    w[at], v[at + 1 if n else at] = h, h
    w[b.first[1:] + np.arange(n)] = END
    v[b.first[:-1] + np.arange(n)] = BEGIN
    return row, v, w


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, their first places in the sorting, and the sums of the values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    return (key[at], order[at], *(np.add.reduceat(x[order], at) if len(at) else x[:0] for x in values))


def _grid(shards: int) -> int:
    return max(1, math.isqrt(max(1, shards - 1)) + 1)


def shard_of(v: np.ndarray, w: np.ndarray, side: int) -> np.ndarray:
    return ((v >> U64(33)) % U64(side) * U64(side) + (w >> U64(33)) % U64(side)).astype(np.int64)


def _dealt(shard: np.ndarray, n: int, *columns: np.ndarray):
    """(shard, bytes of each column) for the shards that have rows."""
    order = np.argsort(shard, kind="stable")
    columns = [c[order] for c in columns]
    edge = np.searchsorted(shard[order], np.arange(n + 1))
    for s in np.flatnonzero(np.diff(edge)):
        yield int(s), [c[edge[s]:edge[s + 1]].tobytes() for c in columns]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


PAIRS = pa.schema([("shard", pa.int32()), ("v", pa.binary()), ("w", pa.binary()), ("n", pa.binary())])
WORDS = pa.schema([("shard", pa.int32()), ("h", pa.binary()), ("facts", pa.binary()), ("totals", pa.list_(pa.int64()))])


def _count(side: int):
    def run(batches):
        held: list[tuple] = []

        def out():
            v, w = (np.concatenate(x) for x in zip(*held))
            held.clear()
            _, at, n = summed(pair_hash(v, w), np.ones(len(v), np.int64))
            return _batch([(s, *c) for s, c in _dealt(shard_of(v[at], w[at], side), side * side, v[at], w[at], n.astype(np.uint32))],
                          PAIRS)
        size = 0
        for b in blocks(batches, lower=True):
            _, v, w = pairs_of(b, b.hashes())
            held.append((v, w))
            size += len(v)
            if size >= FLUSH:
                yield out()
                size = 0
        if held:
            yield out()
    return run


def _counts_of_counts(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)] + [int((n >= 3).sum())]


def _merge_pairs(folder: str, side: int):
    def run(batches):
        shards: dict[int, list] = {}
        for batch in batches:
            for s, v, w, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                shards.setdefault(s, []).append((np.frombuffer(v, U64), np.frombuffer(w, U64), np.frombuffer(n, np.uint32)))
        for s in sorted(shards):
            v, w, n = (np.concatenate(x) for x in zip(*shards.pop(s)))
            key, at, n = summed(pair_hash(v, w), n.astype(np.int64))
            v, w = v[at], w[at]
            many = n >= 255  # a byte holds most counts; the others stand behind, with their places
            put(folder, f"pairs-{s:06d}", np.array([len(n), many.sum()], np.int64).tobytes(), key.tobytes(),
                np.flatnonzero(many).astype(np.int64).tobytes(), n[many].tobytes(), np.minimum(n, 255).astype(np.uint8).tobytes())
            first, _, one, two, more = summed(v, (n == 1).astype(np.int64), (n == 2).astype(np.int64), (n >= 3).astype(np.int64))
            last, _, types, tokens = summed(w, np.ones(len(w), np.int64), n)
            zero = np.zeros(len(first), np.int64)
            h = np.concatenate([first, last])
            facts = np.concatenate([np.stack([zero, zero, one, two, more], 1),
                                    np.stack([tokens, types, *[np.zeros(len(last), np.int64)] * 3], 1)])
            h, _, *sums = summed(h, *facts.T)
            word_shard = ((h >> U64(13)) % U64(side * side)).astype(np.int64)
            # column by column, which compresses well
            rows = [(k, c[0], b"".join(c[1:]), None) for k, c in _dealt(word_shard, side * side, h, *sums)]
            yield _batch([*rows, (s, None, None, _counts_of_counts(n))], WORDS)
    return run


def _merge_words(folder: str):
    """Writes each word shard; a row of totals for each: V, N, all types, counts of counts of types, of pairs."""
    def run(batches):
        shards: dict[int, list] = {}
        pairs = np.zeros(5, np.int64)
        for batch in batches:
            for s, h, facts, totals in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if totals is not None:
                    pairs += totals
                else:
                    shards.setdefault(s, []).append((np.frombuffer(h, U64), np.frombuffer(facts, np.int64).reshape(5, -1).T))
        out = [[0, 0, 0] + [0] * 5 + pairs.tolist()]
        for s in sorted(shards):
            h, facts = (np.concatenate(x) for x in zip(*shards.pop(s)))
            h, _, *sums = summed(h, *facts.T)
            tokens, types = sums[0], sums[1]
            put(folder, f"words-{s:06d}", np.array([len(h)], np.int64).tobytes(), h.tobytes(), *(x.tobytes() for x in sums))
            out.append([int((tokens > 0).sum()), int(tokens.sum()), int(types.sum()), *_counts_of_counts(types), *[0] * 5])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64()))], names=["totals"])
    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """For counts 0, 1, 2 and from 3; where the counts of counts give none, half the count."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n1 and n2 else 1.0, 3 - 4 * y * n4 / n3 if n1 and n3 else 1.5]
    return [0.0] + [min(max(d, 0.0), float(k)) for k, d in enumerate(raw, 1)]


def train(rows: DataFrame, name: str = "lm") -> dict:
    """Counts the texts ``_t`` of ``rows`` and writes the model; returns its folder and totals (a small dict)."""
    spark = rows.sparkSession
    small_batches(spark)
    folder = fresh_dir(spark, name)
    side = _grid(int(spark.conf.get("spark.sql.shuffle.partitions")))
    pairs = rows.select("_t").mapInArrow(_count(side), "shard int, v binary, w binary, n binary")
    words = pairs.repartitionById(side * side, "shard").mapInArrow(
        _merge_pairs(folder, side), "shard int, h binary, facts binary, totals array<bigint>")
    totals = words.repartitionById(side * side, "shard").mapInArrow(_merge_words(folder), "totals array<bigint>")
    sums = totals.agg(*[F.sum(F.get("totals", F.lit(i))).alias(f"t{i}") for i in range(13)]).first()
    t = [int(x or 0) for x in sums]
    written = set(names(folder))
    there = {kind: np.packbits([f"{kind}-{k:06d}" in written for k in range(side * side)]) for kind in ("words", "pairs")}
    return {"folder": folder, "there": there, "side": side, "V": t[0], "N": t[1], "types": t[2],
            "types_nn": t[3:8], "pairs_nn": t[8:13]}


class Model:
    """The written arrays, mapped on first use."""

    def __init__(self, facts: dict):
        self.facts, self.side = facts, facts["side"]
        self.parts: dict[str, tuple] = {}
        self.d2 = np.array(discounts(*facts["pairs_nn"][:4]))
        self.d1 = np.array(discounts(*facts["types_nn"][:4]))
        t = facts["types_nn"]
        spread = self.d1[1] * t[0] + self.d1[2] * t[1] + self.d1[3] * t[4]
        self.unseen = (spread / facts["types"] if facts["types"] else 1.0) / (facts["V"] + 1)

    def part(self, name: str):
        if name not in self.parts:
            kind, shard = name.split("-")
            if np.unpackbits(self.facts["there"][kind])[int(shard)]:
                raw = mapped(f"{self.facts['folder']}/{name}")  # a lost shard is an error
            else:  # no word fell there
                raw = np.zeros(16, np.uint8)
            if name.startswith("words"):
                n = int(raw[:8].view(np.int64)[0])
                a = raw[8:8 + 48 * n]
                self.parts[name] = a[:8 * n].view(U64), a[8 * n:].view(np.int64).reshape(5, n)
            else:
                n, m = raw[:16].view(np.int64).tolist()
                key, over, value, low = np.split(raw[16:], np.cumsum([8 * n, 8 * m, 8 * m]))
                self.parts[name] = key.view(U64), over.view(np.int64), value.view(np.int64), low
        return self.parts[name]

    def look(self, kind: str, shard: np.ndarray, key: np.ndarray, width: int) -> np.ndarray:
        """Facts of distinct keys, 0 where there are none."""
        out = np.zeros((len(key), width), np.int64)
        order = np.lexsort((key, shard))
        edge = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
        for i, j in zip(edge[:-1], edge[1:]):
            own = order[i:j]
            part = self.part(f"{kind}-{int(shard[own[0]]):06d}")
            if not len(part[0]):
                continue
            at = np.minimum(np.searchsorted(part[0], key[own]), len(part[0]) - 1)
            hit = part[0][at] == key[own]
            own, at = own[hit], at[hit]
            if kind == "words":
                out[own] = part[1][:, at].T
            else:
                n = part[3][at].astype(np.int64)
                many = np.flatnonzero(n == 255)
                n[many] = part[2][np.searchsorted(part[1], at[many])]
                out[own, 0] = n
        return out

    def logs(self, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 P(w|v), count of w) of tokens."""
        f, side = self.facts, self.side
        words, place = np.unique(np.concatenate([v, w]), return_inverse=True)
        facts = self.look("words", ((words >> U64(13)) % U64(side * side)).astype(np.int64), words, 5)
        known = facts[place[len(v):]]
        context = facts[place[:len(v)]].astype(np.float64)
        lower = self.unseen
        if f["types"]:
            lower = lower + np.maximum(known[:, 1] - self.d1[np.minimum(known[:, 1], 3)], 0) / f["types"]
        key, first, back = np.unique(pair_hash(v, w), return_index=True, return_inverse=True)
        n = self.look("pairs", shard_of(v[first], w[first], side), key, 1)[back, 0]
        # a word is followed as often as it stands; the begin as often as there are ends
        ends = self.look("words", ((np.array([END]) >> U64(13)) % U64(side * side)).astype(np.int64), np.array([END]), 5)[0, 0]
        total = np.where(v == BEGIN, float(ends), context[:, 0])
        safe = np.maximum(total, 1.0)
        rest = (context[:, 2:] @ self.d2[1:]) / safe
        p = np.where(total > 0, np.maximum(n - self.d2[np.minimum(n, 3)], 0) / safe + rest * lower, lower)
        return np.log10(p), known[:, 0]


def _score(facts: dict):
    def run(batches):
        model = Model(facts)
        floor = math.log10(facts["N"] + 0.1 * (facts["V"] + 1))
        for b in blocks(batches, lower=True):
            n = b.rows.num_rows
            row, v, w = pairs_of(b, b.hashes())
            logs, c = model.logs(v, w)
            total = lambda x: np.bincount(row, weights=x, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [b.rows.column("_doc"), pa.array(np.diff(b.first) + 1, pa.int64()), pa.array(total(c > 0).astype(np.int64)),
                 pa.array(total(np.log10(c + 0.1) - floor)), pa.array(total(logs))],
                names=["_doc", "n_tokens", "n_known", "base_score", "score"])
    return run


def score(docs: DataFrame, carry: list, facts: dict) -> DataFrame:
    """Per row: ``_doc`` (its ``carry`` columns), n_tokens, n_known, base_score, score, perplexity."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*carry).alias("_doc"), text_of("text").alias("_t"))
    kind = T.StructType([rows.schema["_doc"]]).add("n_tokens", T.LongType()).add("n_known", T.LongType()) \
        .add("base_score", T.DoubleType()).add("score", T.DoubleType())
    return rows.mapInArrow(_score(facts), kind).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_mod(FOLDS) == 0)
    facts = train(docs.where(~F.col("held_out")).select(text_of("text").alias("_t")))
    found = score(docs, ["doc_id", "held_out"], facts)
    return found.select("_doc.doc_id", "_doc.held_out", "n_tokens", "n_known", F.lit(facts["N"]).cast("long").alias("train_tokens"),
                        "base_score", "score", "perplexity")
