"""Toxicity by a noisy channel: disguised words are restored, then the restored text is scored.

Restoring.  Suspects are words with letters written as digits or signs, single letters set apart by spaces or marks,
and letters said three times or more; further words with inner marks or a letter doubled, and neighbours of at most
``FRAGMENT`` letters, where the character model gains by reading them without.  For these the text as it stands is a
reading without cost, so that clean words stay; a ``*`` may also hide a letter.  Every sign of a suspect opens a step of a lattice: a letter for itself, a
stand-in for each letter it may mean, a mark or space for nothing or for a word's end, a repetition for nothing.
Viterbi finds the path of the least cost under the channel's costs and a character trigram model, which is counted
over the words of all documents.

Scoring.  Features are the restored text's words and their beginnings (4 and 6 bytes).  A feature's precision is
estimated from the labelled training rows (shrunk to the base rate by ``PRIOR`` rows); those of at least
``STRONG`` form the lexicon; every feature is counted, by a shuffle.  A text's score is the chance that any of its
lexicon features is right: 1 - (1 - floor) * prod(1 - precision).

The fit takes all labelled rows up to about ``MAX_LABELS``, beyond that a share of them by a hash of the id (documented
bound; they are broadcast).  The character model covers all documents; every whole text is scored.

Defined cases: null = empty text = the floor; labels without toxic or doc_id are not used; an id labelled twice
counts twice; repeated rows are scored alike; a null id counts as the empty text for the fold; extra columns pass by;
without labels every text gets the floor; an empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_mod, small_batches, table, text_of
from .textarrays import ALPHANUMERIC, LOWER, U64, Block, blocks, mix, words_of

FOLDS = 5
MAX_LABELS = 400_000
PRIOR = 10
STRONG = 0.5
LEAST_SUPPORT = 3
FLOOR = 0.02
PREFIXES = (4, 6)
FLUSH = 1 << 20
BITS = 20

# What a sign may stand for, marks between letters, and the channel's costs (natural logarithms).
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l"}
MARKS = " .-_*'~^/\\,"
COST_STAND_IN = 0.7
COST_MARK_DROPPED = 0.1
COST_BREAK = 2.5
COST_REPEAT_DROPPED = 0.3
COST_OTHER = 6.0
# where the text as it stands is a reading, at no cost: what the others must save
COST_JOINED = 5.0
COST_DOUBLE_DROPPED = 7.0
COST_MASKED = 2.0
FRAGMENT = 4  # letters of a fragment that spaces set apart

LETTERS = "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = 28  # the edge of a word, 26 letters, all other
CLASS = np.array([LETTERS.find(chr(LOWER[b])) + 1 or 27 for b in range(256)], dtype=np.int64)
STAND_IN = np.array([b < 128 and chr(b) in STANDS_FOR for b in range(256)])
LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
MARK = np.array([b < 128 and chr(b) in MARKS for b in range(256)])


# ------------------------------------------------------------------ the character model

def _trigrams(batches):
    """Counts of three consecutive symbols within words, an edge before and after."""
    count = np.zeros(SYMBOLS ** 3, np.int64)
    for b in blocks(batches, "_t", ALPHANUMERIC, lower=True):
        length = b.end - b.start
        if not len(length):
            continue
        # the words with two edges before and one after each
        begin = np.cumsum(length + 3) - (length + 3)
        s = np.zeros(int((length + 3).sum()), np.int64)
        inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        s[np.repeat(begin + 2, length) + inside] = CLASS[b.data[np.repeat(b.start, length) + inside]]
        code = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
        last = np.zeros(len(s), bool)
        last[begin + length + 1] = True  # triples that begin later would reach into the next word
        last[begin + length + 2] = True
        count += np.bincount(code[~last[:-2]], minlength=len(count))
    at = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at])], names=["code", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Costs -ln P(c | a, b) over SYMBOLS ** 3 entries, counted over all documents; smoothed by lower orders."""
    small_batches(docs.sparkSession)
    counted = docs.select(text_of("text").alias("_t")).mapInArrow(_trigrams, "code int, n bigint") \
        .groupBy("code").agg(F.sum("n").alias("n")).toPandas()  # at most SYMBOLS ** 3 rows
    n = np.zeros(SYMBOLS ** 3)
    n[counted["code"].to_numpy(np.int64)] = counted["n"].to_numpy(np.float64)
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    one = n.sum((0, 1)) + 1
    one = one / one.sum()
    two = n.sum(0) + 20 * one
    two = two / two.sum(1, keepdims=True)
    three = n + 20 * two
    return -np.log(three / three.sum(2, keepdims=True))


# ------------------------------------------------------------------ restoring

def decode(seen: str, cost: np.ndarray, mild: bool = False) -> str:
    """The likeliest words behind a suspect (lower case), one space between.  ``mild``: the text as it stands, its marks
    read as the ends of words, is a reading without cost."""
    best = {(0, 0): (0.0, "")}  # state: the last two symbols of the path
    long_run = {i for m in re.finditer(r"(.)\1\1+", seen) for i in range(m.start() + 1, m.end())}
    spelled = {m.start() for m in re.finditer(r"(?<![^ ]{2}) (?=[^ ](?: |$))", seen)}  # between two single letters
    for i, c in enumerate(seen):
        steps: list[tuple[str, float]] = []  # what the sign writes, and the channel's cost
        if c in STANDS_FOR:
            steps += [(x, COST_STAND_IN) for x in STANDS_FOR[c]]
        elif c in MARKS:
            light = mild and i not in spelled
            steps += [("", COST_JOINED), (" ", 0.0)] if light else [("", COST_MARK_DROPPED), (" ", COST_BREAK)]
            if c == "*" and mild:  # a letter hidden
                steps += [(x, COST_MASKED) for x in LETTERS]
        elif c in LETTERS:
            steps.append((c, 0.0))
        else:
            steps.append((c, 0.0 if c.isalpha() else COST_OTHER))
        if i in long_run:
            steps.append(("", COST_REPEAT_DROPPED))
        elif i and c == seen[i - 1] and c in LETTERS:
            steps.append(("", COST_DOUBLE_DROPPED))
        elif c in STANDS_FOR and c in "!|+$@":
            steps.append(("", COST_OTHER / 2))
        new: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (spent, path) in best.items():
            for out, price in steps:
                if out == "":
                    state, total, text = (a, b), spent + price, path
                elif out == " ":
                    if b == 0:
                        continue
                    state, total, text = (0, 0), spent + price + cost[a, b, 0], path + " "
                else:
                    k = LETTERS.find(out) + 1 or 27
                    state, total, text = (b, k), spent + price + cost[a, b, k], path + out
                if state not in new or total < new[state][0]:
                    new[state] = total, text
        best = new
    return min((spent + cost[a, b, 0], path) for (a, b), (spent, path) in best.items())[1].strip()


def _mild(b: Block, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words the model would rather read without an inner mark or with one letter of two alike, and which it
    would rather read as one with the next word, both being short."""
    symbol = np.where(LETTER[b.data], CLASS[b.data], 0)
    marked, joined = np.zeros(len(b.start), bool), np.zeros(len(b.start), bool)
    if len(b.data) < 3:
        return marked, joined

    def at(place, begin, end):  # the symbol there, an edge outside
        return np.where((place >= begin) & (place < end), symbol[np.clip(place, 0, len(symbol) - 1)], 0)

    def saves(i, begin, end):  # what it saves to drop the sign at i
        a2, a1, b1, b2 = (at(i + k, begin, end) for k in (-2, -1, 1, 2))
        apart = cost[a2, a1, 0] + cost[0, 0, b1] + cost[0, b1, b2]
        return (apart - cost[a2, a1, b1] - cost[a1, b1, b2] > COST_JOINED) & (a1 > 0) & (a1 < 27) & (b1 > 0) & (b1 < 27)

    word = lambda i: np.searchsorted(b.start, i, "right") - 1
    i = np.flatnonzero(MARK[b.data] & (b.data != 32))
    if len(i) and len(b.start):
        w = word(i)
        i, w = i[w >= 0], w[w >= 0]
        hidden = (b.data[i] == ord("*")) & (i > b.start[w]) & (i < b.end[w] - 1)
        marked[w[hidden | saves(i, b.start[w], b.end[w])]] = True
    i = 1 + np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] > 0) & (symbol[1:] < 27))
    if len(i):
        w = word(i)
        i, w = i[i > b.start[w]], w[i > b.start[w]]
        x, a, y = at(i - 2, b.start[w], b.end[w]), symbol[i], at(i + 1, b.start[w], b.end[w])
        marked[w[cost[x, a, a] + cost[a, a, y] - cost[x, a, y] > COST_DOUBLE_DROPPED]] = True
    total = np.concatenate([[0], np.cumsum(LETTER[b.data])])
    letters, length = total[b.end] - total[b.start], b.end - b.start
    short = (letters <= FRAGMENT) & (length <= letters + 2)
    w = np.flatnonzero(short[:-1] & short[1:] & (b.start[1:] == b.end[:-1] + 1) & (b.row[1:] == b.row[:-1]))
    joined[w[saves(b.end[w], b.start[w], b.end[w + 1])]] = True
    return marked, joined


def _suspects(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Which words (not spaces) are suspects, and which of them are in a run of single letters."""
    total = lambda flags: np.concatenate([[0], np.cumsum(flags[b.data])])
    within = lambda sums: sums[b.end] - sums[b.start]
    letters, stands, marks = within(total(LETTER)), within(total(STAND_IN)), within(total(MARK))
    same = np.zeros(len(b.data) + 1, np.int64)
    if len(b.data) > 2:
        low = LOWER[b.data]
        same[3:] = np.cumsum((low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & (b.data[2:] < 128) & LETTER[b.data[2:]])
    length = b.end - b.start
    # a repetition's last letter lies at least two after the word's first
    tripled = (length >= 3) & (same[b.end] - same[np.minimum(b.start + 2, b.end)] > 0)
    spelled = (marks >= 2) & (letters + stands <= marks + 2) & (letters >= 2)
    leet = (stands > 0) & (letters > 0)
    single = (length == 1) & (letters + stands == 1)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    apart = np.zeros(len(length), bool)
    for i, j in edge.reshape(-1, 2):
        if j - i >= 3:
            apart[i:j] = True
    return tripled | spelled | leet | apart, apart


#: What stands between marks.
PLAIN = re.compile("[^" + re.escape(MARKS) + "]+")
#: Closing signs that are punctuation, not letters.
CLOSING = re.compile(r"[!|+.,;:?)\]}\"'*%&#$@-]+$")


def restored(b: Block, cost: np.ndarray) -> pa.Array:
    """The block's texts with suspects replaced by what they are read as; other texts as they are."""
    read = lru_cache(1 << 16)(lambda s: decode(s, cost))
    gently = lru_cache(1 << 16)(lambda s: decode(s, cost, True))
    strong, apart = _suspects(b)
    marked, joined = _mild(b, cost)
    # words of one run: single letters apart, and what is joined to the next
    on = np.zeros(len(apart), bool)
    on[:-1] = joined[:-1] | (apart[:-1] & apart[1:] & (b.row[1:] == b.row[:-1]))
    after = np.zeros(len(apart), bool)
    after[1:] = on[:-1]
    texts = [b.data[b.offsets[r]:b.offsets[r + 1]].tobytes() for r in range(len(b.offsets) - 1)]
    parts: dict[int, list[bytes]] = {}
    done: dict[int, int] = {}
    for w in np.flatnonzero((strong | marked | on) & ~after).tolist():
        r, j = int(b.row[w]), w
        while on[j]:
            j += 1
        s, e = int(b.start[w]), int(b.end[j])
        word = b.data[s:e].tobytes().decode().lower()
        mild = not strong[w] or bool(joined[w:j].any() and not apart[w:j + 1].all())
        if j > w:
            word = " ".join(word.split())
        bare = CLOSING.sub("", word)
        if len(bare) > 2 and bare.strip("0123456789"):
            out = gently(bare) if mild else read(bare)
            if mild and out.split() == PLAIN.findall(bare):
                continue
            parts.setdefault(r, []).extend([texts[r][done.get(r, 0):s - b.offsets[r]], out.encode(), word[len(bare):].encode()])
            done[r] = e - int(b.offsets[r])
    for r, pieces in parts.items():
        texts[r] = b"".join([*pieces, texts[r][done[r]:]])
    return pa.array(texts, pa.large_binary()).cast(pa.large_string())


def restore(docs: DataFrame, cost: np.ndarray, carry: list[str]) -> DataFrame:
    """Per row: ``_doc`` (its ``carry`` columns) and ``restored``, the text with disguised words read."""
    model = docs.sparkSession.sparkContext.broadcast(cost)

    def run(batches):
        for b in blocks(batches):
            yield pa.RecordBatch.from_arrays([b.rows.column("_doc"), restored(b, model.value).cast(pa.string())],
                                             names=["_doc", "restored"])
    rows = docs.select(F.struct(*carry).alias("_doc"), text_of("text").alias("_t"))
    return rows.mapInArrow(run, T.StructType([rows.schema["_doc"]]).add("restored", T.StringType()))


# ------------------------------------------------------------------ scoring

def features(b: Block, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the restored texts: each word and its beginnings, with repetitions."""
    w = words_of(b.rows, restored(b, cost), ALPHANUMERIC, True)
    rows, values = [w.row], [w.hashes()]
    for k in PREFIXES:
        longer = w.end - w.start > k
        cut = dataclasses.replace(w, start=w.start[longer], end=w.start[longer] + k, row=w.row[longer])
        rows.append(cut.row)
        values.append(mix(cut.hashes() + U64(k)))
    return np.concatenate(rows), np.concatenate(values)


def _distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def _member(sorted_keys: np.ndarray, bitmap: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values that are among the keys, and their places there."""
    at = np.flatnonzero(bitmap[(value >> U64(64 - BITS)).astype(np.int64)])
    if not len(sorted_keys):
        return at[:0], at[:0]
    place = np.minimum(np.searchsorted(sorted_keys, value[at]), len(sorted_keys) - 1)
    hit = sorted_keys[place] == value[at]
    return at[hit], place[hit]


def _bitmap(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << BITS, bool)
    out[(keys >> U64(64 - BITS)).astype(np.int64)] = True
    return out


def _documents_with(model):
    """(feature, p, q): in how many of the toxic and of the other rows each feature occurs."""
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out():
            value, at = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
            toxic = np.concatenate([t for _, t in held])
            held.clear()
            p = np.bincount(at[toxic], minlength=len(value))
            q = np.bincount(at[~toxic], minlength=len(value))
            return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(p.astype(np.int64)), pa.array(q.astype(np.int64))],
                                              names=["f", "p", "q"])
        size = 0
        for b in blocks(batches):
            row, value = _distinct(*features(b, model.value))
            held.append((value, b.rows.column("toxic").to_numpy(zero_copy_only=False)[row] == 1))
            size += len(value)
            if size > FLUSH:
                yield out()
                size = 0
        if held:
            yield out()
    return run


def train(docs: DataFrame, labels: DataFrame, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lexicon: features (sorted) and their precision."""
    spark = docs.sparkSession
    use = labels.where("doc_id is not null and toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic")) \
        .where(id_mod(FOLDS) != 0)
    n = use.count()
    if n > MAX_LABELS:
        share = int(MAX_LABELS / n * (1 << 30))
        use = use.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    size = {r["toxic"]: r["count"] for r in use.groupBy("toxic").count().collect()}
    if not size.get(1) or not size.get(0):
        return np.zeros(0, U64), np.zeros(0)
    text = docs.select("doc_id", text_of("text").alias("_t"))
    model = spark.sparkContext.broadcast(cost)

    rows = text.join(F.broadcast(use.where("toxic in (0, 1)")), "doc_id").select("_t", "toxic")
    base = size[1] / (size[0] + size[1])
    found = rows.mapInArrow(_documents_with(model), "f bigint, p bigint, q bigint").groupBy("f").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    # only strong features reach the driver: each is in several toxic rows, whose number is bounded
    strong = found.where(F.col("p") >= LEAST_SUPPORT) \
        .select("f", ((F.col("p") + F.lit(PRIOR * base)) / (F.col("p") + F.col("q") + F.lit(PRIOR))).alias("precision")) \
        .where(F.col("precision") >= STRONG).toPandas()
    keys = strong["f"].to_numpy(np.int64).view(U64)
    order = np.argsort(keys)
    return keys[order], strong["precision"].to_numpy(np.float64)[order]


def score(docs: DataFrame, carry: list, cost: np.ndarray, lexicon: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per row: ``_doc`` (its ``carry`` columns) and ``score``."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((cost, *lexicon))

    def run(batches):
        model, keys, precision = held.value
        bitmap, weight = _bitmap(keys), np.log1p(-np.minimum(precision, 1 - 1e-9))
        for b in blocks(batches):
            row, value = features(b, model)
            at, place = _member(keys, bitmap, value)
            row, place = _distinct(row[at], place)
            out = 1 - (1 - FLOOR) * np.exp(np.bincount(row, weights=weight[place], minlength=b.rows.num_rows))
            yield pa.RecordBatch.from_arrays([b.rows.column("_doc"), pa.array(out)], names=["_doc", "score"])
    rows = docs.select(F.struct(*carry).alias("_doc"), text_of("text").alias("_t"))
    return rows.mapInArrow(run, T.StructType([rows.schema["_doc"]]).add("score", T.DoubleType()))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_mod(FOLDS) == 0)
    cost = character_model(docs)
    lexicon = train(docs, table(spark, sf_dir, "labels"), cost)
    return score(docs, ["doc_id", "held_out"], cost, lexicon).select(
        "_doc.doc_id", "_doc.held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
