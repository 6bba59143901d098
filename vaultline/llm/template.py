"""Main text of web pages: what recurs across a host's pages goes, then page furniture, and the article stays.

1. Every page is read into its element tree, and every subtree gets a hash of its names, classes and texts (runs of
   digits count as one digit, so that dates and counters don't hide a recurring notice).
2. Spark counts subtrees per host.  A subtree counts once for every *rest* beside which it stands: the two longest texts
   of the article (of the page, if it marks none) outside of the subtree.  Exact copies of a page have one rest, and near
   copies few, so an article that was published many times doesn't pass for a template, however many copies a host holds.
3. Subtrees that stand beside at least ``MANY`` rests of their host are deleted from its pages.  Within an article, and
   on pages that mark none, they must stand beside ``SHARE`` of the host's rests as well, and plain text elements
   (a paragraph or heading without class or id, not all of it a link) always stay: authors repeat themselves.
4. A host with few pages shows no template, so what an element's name, role or class declares as furniture (menus,
   footers, adverts, forms, comments) goes as well, unless the article lies in it.
5. What is left of the article is the text; of the page's body where none is marked.

The pages' tree is built twice, for counting and for the text.  What comes back to a page are the ordinal numbers of its
own subtrees that are templates, so nothing grows with the templates of its host; the two meet by a hash of the page,
for which the pages travel once, in blocks that are compressed together.

Defined cases: null = empty html = empty text; a null url, or one without a host, belongs to the host without a name;
repeated rows are pages with one rest; pages may be of any length or broken anywhere (a tag, comment or script left open
takes what follows); other columns pass by; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, small_batches, table, text_of
from .htmltree import COMMENTS, Page

MANY = 3
SHARE = 0.1
MANY_WITHIN = 5
PLAIN = set("p h1 h2 h3 h4 h5 h6 blockquote pre b i em strong span a li ul ol dl dt dd td tr table tbody thead figure figcaption".split())
#: Named furniture that holds this share of a page's texts is taken for the page itself.
BULK = 0.5
SUBTREES = pa.schema([("host", pa.string()), ("within", pa.bool_()), ("key", pa.int64()), ("rest", pa.int64()),
                      ("page", pa.int64()), ("ordinal", pa.int32())])
NO_KEY = 0
#: Bytes of pages that a task holds before it passes them on.
HELD = 24 << 20
KEY = ["host", "within", "key"]


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True) or 1


def regions(page: Page) -> list:
    """The outermost articles that aren't furniture, or the whole page."""
    marked = [e for e in page.elements if e.article and e.texts]
    inner = [e for e in marked if e.tag != "main"]
    marked = inner or marked  # a main element with articles in it holds more than these
    out, end = [], -1
    for e in marked:
        if e.first >= end and not e.away:
            out.append(e)
            end = e.end
    return out or [page.root]


def candidates(page: Page, main: list):
    """(element, lies in the article or on a page without one) of the subtrees that may be a template's."""
    whole = main[0] is page.root
    spans = [(e.first, e.end) for e in main]
    k = 0
    for e in page.elements:
        if not e.texts:
            continue
        while k < len(spans) - 1 and spans[k][1] <= e.first:
            k += 1
        a, b = spans[k]
        inside = a <= e.first and e.end <= b
        if not whole and (e.holds_article or (inside and e.article)):
            continue
        if inside and e.tag in PLAIN and e.kind.bare and (e.linked < e.texts or e.tag == "a"):
            continue
        yield e, inside


def _longer(top, x):
    """The two largest of ``top`` (two, falling) and the pieces of ``x``."""
    for y in x:
        if y > top[0]:
            top = (y, top[0])
        elif y > top[1]:
            top = (top[0], y)
    return top


def _rests(page: Page, main: list):
    """For a range of pieces, a hash of the article's two longest texts outside of it (None if there is none)."""
    none = (0, 0)
    value = [()] * len(page.pieces)
    for e in main:
        for i in range(e.first, e.end):
            piece = page.pieces[i]
            if piece and (text := piece.strip()):
                value[i] = ((len(text), xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))),)
    before = list(accumulate(value, _longer, initial=(none, none)))
    after = list(accumulate(reversed(value), _longer, initial=(none, none)))[::-1]

    def rest(a: int, b: int) -> int | None:
        (size, one), (_, two) = _longer(before[a], after[b])
        return ((one * 31 + two) & ((1 << 64) - 1)) >> 1 if size else None
    return rest


def _subtrees(batches):
    """Each candidate of each page of the batch, repeated pages once; a page's own rest stands under ``NO_KEY``."""
    for batch in batches:
        out, met = [], set()
        for host, html, name in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "page"))):
            if name in met:
                continue
            met.add(name)
            page = Page(html)
            main = regions(page)
            rest = _rests(page, main)
            own = rest(0, 0)
            if own is not None:
                out.append((host, False, NO_KEY, own, name, -1))
            for i, (e, inside) in enumerate(candidates(page, main)):
                beside = rest(e.first, e.end)
                if beside is not None:
                    out.append((host, inside, _number(e.digest), beside, name, i))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], f.type) for i, f in enumerate(SUBTREES)], schema=SUBTREES)


def _named(pages: DataFrame) -> list[Column]:
    """A page's host, html and name (a hash of both: equal pages of a host are alike)."""
    host, html = host_of(F.col("url")), text_of("html")
    return [host.alias("host"), html.alias("html"), F.xxhash64(host, html).alias("page")]


def templates(subtrees: DataFrame) -> DataFrame:
    """(host, within, key, n) of the subtrees that recur across many of their host's pages; n rests beside them."""
    counts = saved(subtrees.groupBy(*KEY).agg(F.count_distinct("rest").alias("n"))
                   .where((F.col("key") == NO_KEY) | (F.col("n") >= MANY)), "template-counts")
    hosts = counts.where(F.col("key") == NO_KEY).select("host", F.col("n").alias("rests"))
    return counts.where(F.col("key") != NO_KEY).join(hosts, "host").where(
        ~F.col("within") | (F.col("n") >= F.greatest(F.lit(MANY_WITHIN), F.ceil(SHARE * F.col("rests"))))).drop("rests")


def main_text(source: str, ordinals) -> tuple[str, int]:
    """The text of a page given which of its candidates are templates, and how many subtrees were deleted as such."""
    page = Page(source)
    main = regions(page)
    gone, deleted, end, ordinals = [], 0, -1, set(ordinals)
    for i, (e, _) in enumerate(candidates(page, main) if ordinals else ()):
        if e.first >= end and i in ordinals:
            gone.append((e.first, e.end))
            deleted, end = deleted + 1, e.end
    texts = max(page.root.texts, 1)
    for e in page.elements:
        if e.furniture and not e.holds_article and e.texts:
            named = e.tag not in ("nav", "footer", "aside", "script", "style", "template", "noscript") and not any(n in COMMENTS for n in e.kind.names)
            if not (named and main[0] is page.root and e.texts > BULK * texts):
                gone.append((e.first, e.end))
    return page.text([(e.first, e.end) for e in main], gone), deleted


def _packed(parts: int):
    """Blocks of the pages that go to one partition, as compressed Arrow batches."""
    def packed(held):
        rows = pa.Table.from_batches(held).combine_chunks()
        part = np.mod(np.asarray(rows.column("page")), parts)
        order = np.argsort(part, kind="stable")
        edge = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
        out = []
        for i, j in zip(edge[:-1], edge[1:]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as stream:
                stream.write_table(rows.take(pa.array(order[i:j])))
            out.append((int(part[order[i]]), zstandard.compress(sink.getvalue().to_pybytes(), 3)))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())],
                                          names=["part", "blob"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size > HELD:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)
    return run


def _extract(batches):
    """Rows come by partition, the ordinals of its pages before the blocks."""
    known, last = {}, None
    for batch in batches:
        for part, name, ordinals, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "page", "ordinals", "blob"))):
            if part != last:
                known, last = {}, part
            if blob is None:
                known[name] = ordinals
                continue
            for rows in pa.ipc.open_stream(zstandard.decompress(blob)):
                out = [main_text(html, known.get(name, ())) for html, name in zip(rows.column("html").to_pylist(), rows.column("page").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("_page"), pa.array([x[0].encode("utf-8", "replace") for x in out], pa.binary()).cast(pa.string()),
                     pa.array([len(x[0]) for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())],
                    names=["_page", "text", "n_chars", "n_templates"])


def extract(pages: DataFrame, carry: list[str]) -> DataFrame:
    """Per row: ``_page`` (its ``carry`` columns), text, n_chars, n_templates (subtrees deleted as the host's template)."""
    spark = pages.sparkSession
    small_batches(spark)
    kind = "host string, within boolean, key bigint, rest bigint, page bigint, ordinal int"
    subtrees = saved(pages.select(*_named(pages)).mapInArrow(_subtrees, kind), "template-subtrees")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = subtrees.join(templates(subtrees).select(*KEY), KEY).groupBy("page").agg(F.collect_set("ordinal").alias("ordinals")) \
        .select(F.pmod("page", F.lit(n)).cast("int").alias("part"), "page", "ordinals", F.lit(None).cast("binary").alias("blob"))
    rows = pages.select(F.struct(*carry).alias("_page"), *_named(pages)).drop("host")
    blocks = rows.mapInArrow(_packed(n), "part int, blob binary").select(
        "part", F.lit(None).cast("bigint").alias("page"), F.lit(None).cast("array<int>").alias("ordinals"), "blob")
    out = f"_page {rows.schema['_page'].dataType.simpleString()}, text string, n_chars bigint, n_templates bigint"
    met = known.unionByName(blocks).repartitionById(n, "part").sortWithinPartitions("part", F.col("blob").isNotNull())
    return met.mapInArrow(_extract, out)


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"]).select("_page.page_id", "_page.url", "text", "n_chars", "n_templates")
