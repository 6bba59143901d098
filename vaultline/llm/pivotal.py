"""Spelling variants by pivotal grams: words one edit apart, and the frequent form that each rare one belongs to.

1. Words are counted in tasks and summed.  All bigrams of the distinct words are ranked, rare ones first.
2. A word's *prefix* are its bigrams up to the rank of its third rarest.  Its *pivots* are two disjoint bigrams of the
   prefix with the shortest lists, chosen by dynamic programming over their positions.  One edit spoils one pivot at
   most; so of two words one edit apart, the one whose prefix ends earlier has a pivot in the other's prefix.
3. Pivots are joined with prefixes.  Position limits go into the join key: an edit lies either right of the surviving
   pivot, and both words are equal up to its end, or left of it, and they are equal from its start on.  The other side
   is cut into pieces of ``PIECE`` code points at most; all but the edited piece are equal as well and belong to the key.
   A list thus holds words that agree but for ``PIECE`` neighbouring code points, however many words share a bigram.
4. Candidates are verified by edit distance.  Forms are followed to their last by doubling: a form is at least
   ``RATIO`` times as frequent, so chains are no longer than the digits of the largest count.

What tasks get of the corpus is the bigram table: the alphabet has 90 code points (a-z, U+00C0 to U+00FF), so it has
8,100 entries at most.

Defined cases: null = empty text = no words; a null doc_id counts as the empty text in the checksum; rows with equal
doc_id or text are counted as they stand; texts may be of any length; other columns are not read; an empty table or
one without repeated words gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, small_batches, table, text_of
from .textarrays import U64, mix

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
GARBLED = 31
PIECE = 3
#: Distinct words that a task counts before it passes them on, and the text length from which words aren't listed.
HELD = 1 << 18
LONG_TEXT = 1 << 22


def _counts(min_length: int, garbled: int | None):
    pattern = re.compile(f"[a-zÀ-ÿ]{{{min_length},}}")

    def listed(total):
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches):
        total: dict[str, int] = {}
        for batch in batches:
            for doc, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
                small = text.lower().decode()  # bytes know only A-Z
                found = pattern.findall(small) if len(small) < LONG_TEXT else (m.group() for m in pattern.finditer(small))
                seed = zlib.crc32(f"{doc}:".encode())
                for word, n in Counter(found).items():
                    if garbled:
                        h = zlib.crc32(word.encode(), seed)
                        if h % garbled == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < min_length:
                                continue
                    total[word] = total.get(word, 0) + n
                if len(total) > HELD:
                    yield listed(total)
                    total = {}
        yield listed(total)
    return run


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, garbled: int | None = None) -> DataFrame:
    """(word, n): runs of letters of at least ``min_length`` code points, A-Z lower-cased, with their counts.

    ``garbled`` plants misspellings to measure with: a run loses a code point in every document where the checksum of
    document and run is a multiple of it.
    """
    if min_length < 4:
        raise ValueError("a prefix has three bigrams: words need four code points")
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), text_of("text").cast("binary").alias("t"))
    words = rows.mapInArrow(_counts(min_length, garbled), "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _by_length(words: pa.Array):
    """(places in the batch, matrix of code points) of the words of each length."""
    texts = words.to_pylist()
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    start = np.cumsum(length) - length
    for n in np.unique(length):
        place = np.flatnonzero(length == n)
        yield place, flat[start[place][:, None] + np.arange(n)].astype(U64)


def _grams(points: np.ndarray) -> np.ndarray:
    return points[:, :-1] << U64(32) | points[:, 1:]


def _gram_counts(batches):
    total: Counter = Counter()
    for batch in batches:
        for _, points in _by_length(batch.column("word")):
            gram, n = np.unique(_grams(points), return_counts=True)
            total.update(dict(zip(gram.tolist(), n.tolist())))
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["gram", "n"])


def disjoint(weight: np.ndarray) -> np.ndarray:
    """For each row the two places, at least two apart, with the least sum of weights: a mask.

    ``one`` is the best single place so far that is disjoint from the place looked at, ``two`` the best pair so far.
    """
    rows, places = weight.shape
    one = np.full(rows, np.inf)
    two = np.full(rows, np.inf)
    first, pair = np.zeros(rows, np.int64), np.zeros((rows, 2), np.int64)
    for i in range(2, places):
        better = weight[:, i - 2] < one
        one = np.where(better, weight[:, i - 2], one)
        first = np.where(better, i - 2, first)
        better = one + weight[:, i] < two
        two = np.where(better, one + weight[:, i], two)
        pair[better] = np.stack([first[better], np.full(better.sum(), i)], axis=1)
    out = np.zeros(weight.shape, bool)
    np.put_along_axis(out, pair, True, axis=1)
    return out


def _pieces(size: int) -> list[tuple[int, int]]:
    n = -(-size // PIECE)
    return [(size * j // n, size * (j + 1) // n) for j in range(n)]


def _rolled(points: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first 0, 1, ... code points of each row."""
    out = [np.zeros(len(points), U64)]
    for k in range(points.shape[1]):
        out.append(mix(out[-1] * U64(0xFF51AFD7ED558CCD) + points[:, k] + U64(1)))
    return out


def _tag(*numbers: int) -> np.uint64:
    h = np.zeros(1, U64)
    for x in numbers:
        h = mix(h * U64(0xC2B2AE3D27D4EB4F) + U64(x + 1))
    return h[0]


def _signatures(grams, pivots: bool):
    """Rows (key, word, n, last) of each word's pivots, or of its prefix; ``last`` is the rank at which the prefix ends."""
    def run(batches):
        code, rank, count = grams.value
        for batch in batches:
            word, n = batch.column("word"), batch.column("n")
            for place, points in _by_length(word):
                size = points.shape[1]
                at = np.searchsorted(code, _grams(points))
                ranks = rank[at]
                last = np.partition(ranks, 2, axis=1)[:, 2]
                chosen = ranks <= last[:, None]
                if pivots:
                    chosen = disjoint(np.where(chosen, count[at].astype(float), np.inf))
                head, tail = _rolled(points), _rolled(points[:, ::-1])
                keys, own = [], []
                for p in range(size - 1):
                    r = np.flatnonzero(chosen[:, p])
                    if not len(r):
                        continue
                    for longer in (size, size + 1):  # the longer word's length
                        for a, b in _pieces(longer - p - 2):  # the edit stands right of the pivot
                            keys.append(mix(head[p + 2 + a][r] + mix(tail[longer - p - 2 - b][r] ^ _tag(0, longer, p, a))))
                            own.append(r)
                        for a, b in _pieces(longer - size + p):  # left of it
                            keys.append(mix(head[a][r] + mix(tail[longer - b][r] ^ _tag(1, longer, size - p, a))))
                            own.append(r)
                r = np.concatenate(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), word.take(pa.array(place[r])), n.take(pa.array(place[r])),
                     pa.array(last[r].astype(np.int32))], names=["key", "word", "n", "last"])
    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every pair of distinct words one edit apart, once.  ``words`` (word, n) is read three times;
    its words are of the pattern's alphabet and at least four code points long."""
    spark = words.sparkSession
    # at most 8,100 rows
    counts = [(r["gram"], r["n"]) for r in words.mapInArrow(_gram_counts, "gram bigint, n bigint")
              .groupBy("gram").agg(F.sum("n").alias("n")).collect()]
    counts.sort()
    order = sorted(range(len(counts)), key=lambda i: counts[i][::-1])
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    grams = spark.sparkContext.broadcast((np.array([g for g, _ in counts], U64), rank, np.array([n for _, n in counts], np.int64)))
    kind = "key bigint, word string, n bigint, last int"
    pivot, prefix = (words.select("word", "n").mapInArrow(_signatures(grams, x), kind).alias(a) for x, a in ((True, "r"), (False, "s")))
    found = pivot.join(prefix, (F.col("r.key") == F.col("s.key"))
                       & ((F.col("r.last") < F.col("s.last")) | ((F.col("r.last") == F.col("s.last")) & (F.col("r.word") < F.col("s.word"))))
                       & (F.levenshtein(F.col("r.word"), F.col("s.word"), 1) == 1))
    first = F.col("r.word") < F.col("s.word")
    return found.select(*[F.when(first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(name)
                          for name, x, y, c in (("a", "r", "s", "word"), ("a_n", "r", "s", "n"), ("b", "s", "r", "word"), ("b_n", "s", "r", "n"))]) \
        .distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: each turn lets every word jump to where its root points."""
    at = saved(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        step = saved(at.alias("x").join(at.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
                     .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        at = step.select("word", "root")


def group(docs: DataFrame, ratio: int = RATIO, **options) -> DataFrame:
    """Per word: n, n_near (words one edit apart), form (the most frequent of them, if at least ``ratio`` times as
    frequent; equal counts by code points), form_n, root (the end of its chain of forms, or itself)."""
    words = saved(vocabulary(docs, **options), "variant-words")
    pairs = near_pairs(words)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word")).alias("other")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("word")).alias("other")),
    )).alias("x")).select("x.*")
    near = saved(both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min("other").alias("top"))
                 .select("word", "n_near", F.when(-F.col("top.n") >= ratio * F.col("n"), F.col("top")).alias("top"))
                 .select("word", "n_near", F.col("top.word").alias("form"), (-F.col("top.n")).alias("form_n")), "variant-near")
    roots = _roots(near.where("form is not null"))
    return words.join(near, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(table(spark, sf_dir, "documents"), garbled=GARBLED)


# Near words by what is left without one code point: equal rests at one place (replaced), or a rest that is a word.
ORACLE = r"""
WITH runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (
  SELECT *, list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'),
                           lambda x: ('0x' || x)::BIGINT) AS v FROM d),
h AS (
  SELECT run, c, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], v), lambda s, x:
           list_reduce(list_concat([xor(s, x)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                       lambda r, z: xor(r >> 1, 3988292384 * (r & 1))))) AS h FROM bytes),
g AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c FROM h),
w AS (SELECT word, sum(c)::BIGINT AS n FROM g WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM w, unnest(range(0, length(word))) AS u(i)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN w b ON a.rest = b.word),
top AS (
  SELECT word, n, count(*) AS n_near, max(other_n) AS top_n, arg_min(other, (-other_n, encode(other))) AS top FROM near GROUP BY word, n),
form AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top_n >= 10 * w.n THEN top END AS form,
         CASE WHEN top_n >= 10 * w.n THEN top_n END AS form_n FROM w LEFT JOIN top ON w.word = top.word),
r1 AS (SELECT f.*, coalesce(g.form, f.form, f.word) AS r FROM form f LEFT JOIN form g ON f.form = g.word),
r2 AS (SELECT f.*, coalesce(g.r, f.r) AS r_2 FROM r1 f LEFT JOIN r1 g ON f.r = g.word),
r3 AS (SELECT f.*, coalesce(g.r_2, f.r_2) AS r_3 FROM r2 f LEFT JOIN r2 g ON f.r_2 = g.word)
SELECT f.word, f.form, coalesce(g.r_3, f.r_3) AS root, f.n, f.n_near, f.form_n FROM r3 f LEFT JOIN r3 g ON f.r_3 = g.word
"""
