"""Vault row projections: hubs, links, satellites, history satellites.

Input is a *decoded* event frame (see ``operators.decode``) of one source
table, already past ``skip_deletes`` and the reject split.  Each projection is
a narrow ``select`` (no shuffle).  Keyed tables are reduced to one row per key
with a partial-then-final aggregate, so a key that owns a third of a batch costs
one row per map task after the exchange, never one hot reducer holding all its
rows: ``last_rows`` reduces a batch's events by the business keys, before they
are hashed, so that the exchange carries no hex text; ``keyed_view`` reduces
stored rows by their hash keys.

Every output row carries ``_order = struct(batch_id, partition, offset, load_dt)``:
the arrival order used for last-write-wins.  A record's time is only the last
tie-break, so the result does not depend on how events fall into batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import coerce_compat, coerce_typed
from ..functions.hashing import hash_diff, hub_hash
from ..model import SourceTable, TargetTable, VaultModel, hk
from .decode import present

ORDER = "_order"
FIRST_SEEN = "first_load_dt"
_DIFF = "_diff"  # a content hash as 16 bytes


def _order(batch_id) -> Column:
    b = batch_id if isinstance(batch_id, Column) else F.lit(int(batch_id))
    return F.struct(b.cast("bigint").alias("batch_id"), F.col("partition"), F.col("offset"),
                    F.col("load_dt")).alias(ORDER)


def _meta(batch_id) -> list[Column]:
    return [F.col("load_dt"), F.col("topic").alias("record_source"), _order(batch_id)]


def _after(name: str) -> Column:
    return F.col(f"after.{name}")


def _ref_hk(ref) -> Column:
    return hub_hash(_after(ref.field))


def _link_key(refs, first: Column | None = None) -> Column:
    parts = ([first] if first is not None else []) + [_ref_hk(r) for r in refs]
    return F.md5(F.concat(*parts))


def _attr_values(attrs, coercion: str) -> list[Column]:
    out = []
    for a in attrs:
        w = _after(a.name)
        v = coerce_compat(w, a.name, a.declared) if coercion == "compat" else coerce_typed(w, a.declared)
        out.append(v.alias(a.name))
    return out


def _hash_diff(attrs) -> Column:
    return hash_diff([(a.name, _after(a.name), a.wire_kind) for a in attrs]).alias("hash_diff")


def _hub_keys(src: SourceTable) -> tuple[Column, list[Column]]:
    bk = _after(src.business_key.name)
    return bk.isNotNull(), [hub_hash(bk)]


def target_keys(src: SourceTable, target: TargetTable) -> tuple[Column, list[Column] | None]:
    """(row condition, unique-key expressions) of a vault table over decoded rows.

    The condition is which events produce a row (business key present; every
    referenced key present and non-empty for links and link satellites; parent
    key for history rows).  Keys are ``None`` for append-only history tables.
    """
    bk = _after(src.business_key.name) if src.business_key is not None else None
    refs_ok = F.lit(True)
    for r in target.refs:
        refs_ok = refs_ok & present(_after(r.field))
    if target.kind == "hub":
        return _hub_keys(src)
    if target.kind == "link":
        if bk is not None:
            return refs_ok & bk.isNotNull(), [_link_key(target.refs, hub_hash(bk))]
        return refs_ok, [_link_key(target.refs)]
    if target.kind == "sat":
        if bk is not None:
            return bk.isNotNull(), [hub_hash(bk), _hash_diff(target.attrs)]
        return refs_ok, [_link_key(target.refs), _hash_diff(target.attrs)]
    return present(_after(target.refs[0].field)), None


def hub_rows(decoded: DataFrame, src: SourceTable, batch_id=0) -> DataFrame:
    cond, (key,) = _hub_keys(src)
    bk = _after(src.business_key.name)
    first = F.col(FIRST_SEEN if FIRST_SEEN in decoded.columns else "load_dt")
    return decoded.where(cond).select(
        key.alias(hk(src.name)), bk.cast("string").alias(src.business_key.name), *_meta(batch_id),
        first.alias(FIRST_SEEN))


def link_rows(decoded: DataFrame, src: SourceTable, target: TargetTable, batch_id=0) -> DataFrame:
    """Link rows; skipped when any referenced business key is NULL or empty."""
    cond, (key,) = target_keys(src, target)
    refs = target.refs
    if src.business_key is not None:
        r = refs[0]
        return decoded.where(cond).select(
            key.alias(hk(target.name)), hub_hash(_after(src.business_key.name)).alias(hk(src.name)),
            _ref_hk(r).alias(hk(r.target)), *_meta(batch_id))
    return decoded.where(cond).select(
        key.alias(hk(target.name)), *[_ref_hk(r).alias(hk(r.target)) for r in refs], *_meta(batch_id))


def sat_rows(decoded: DataFrame, src: SourceTable, target: TargetTable, batch_id=0,
             coercion: str = "typed") -> DataFrame:
    """Satellite rows on a hub (or on a link for link tables), keyed by content hash."""
    cond, (key, diff) = target_keys(src, target)
    if _DIFF in decoded.columns:  # reduced events bring it
        diff = F.lower(F.hex(_DIFF)).alias("hash_diff")
    return decoded.where(cond).select(key.alias(target.distribute_by), diff, *_meta(batch_id),
                                      *_attr_values(target.attrs, coercion))


def history_rows(decoded: DataFrame, src: SourceTable, target: TargetTable, batch_id=0,
                 coercion: str = "typed") -> DataFrame:
    """Append-only history rows keyed by the parent hub; rows without a parent key skip."""
    cond, _ = target_keys(src, target)
    r = target.refs[0]
    return decoded.where(cond).select(
        _ref_hk(r).alias(hk(r.target)), F.col("load_dt"), _hash_diff(target.attrs),
        F.col("topic").alias("record_source"), _order(batch_id),
        *_attr_values(target.attrs, coercion))


def target_rows(decoded: DataFrame, src: SourceTable, target: TargetTable, batch_id=0,
                coercion: str = "typed") -> DataFrame:
    """The rows of any vault table that the source feeds."""
    if target.kind == "hub":
        return hub_rows(decoded, src, batch_id)
    if target.kind == "link":
        return link_rows(decoded, src, target, batch_id)
    return (sat_rows if target.kind == "sat" else history_rows)(decoded, src, target, batch_id, coercion)


def last_events(decoded: DataFrame, src: SourceTable, target: TargetTable, batch_id=0) -> DataFrame:
    """Per key of a keyed table the event that is loaded last, with the fields which the table needs.

    The hash keys are functions of the business keys, so the events are grouped by these and hashed afterwards; a
    satellite's content hash is a key of 16 bytes.  Grouping and order are those of ``keyed_view``, and so are the rows.
    """
    cond, _ = target_keys(src, target)
    keys = [src.business_key.name] if src.business_key is not None else []
    if target.kind == "link" or not keys:
        keys += [r.field for r in target.refs if r.field not in keys]
    attrs = [a.name for a in target.attrs if a.name not in keys] if target.kind == "sat" else []
    by = [_after(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    if target.kind == "sat":
        by.append(F.unhex(_hash_diff(target.attrs)).alias(_DIFF))
    event = F.struct(_order(batch_id), F.col("topic"), *[_after(a).alias(a) for a in attrs]).alias("_e")
    aggs = [F.max("_e").alias("_e")]
    if target.kind == "hub":
        aggs.append(F.min("_e._order.load_dt").alias(FIRST_SEEN))
    last = decoded.where(cond).select(*by, event)
    names = last.columns[:-1]
    after = F.struct(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], *[F.col(f"_e.{a}").alias(a) for a in attrs])
    return last.groupBy(*names).agg(*aggs).select(
        "_e.topic", *[F.col(f"_e._order.{c}").alias(c) for c in ("batch_id", "partition", "offset", "load_dt")],
        after.alias("after"), *[c for c in (_DIFF, FIRST_SEEN) if c in names or c == FIRST_SEEN and len(aggs) > 1])


def last_rows(decoded: DataFrame, src: SourceTable, target: TargetTable, batch_id=0, coercion: str = "typed",
              keep_order: bool = False) -> DataFrame:
    """``keyed_view`` of a keyed table's rows, from events that are reduced before they become rows."""
    df = target_rows(last_events(decoded, src, target, batch_id), src, target, F.col("batch_id"), coercion)
    return df if keep_order else df.drop(ORDER)


def keyed_view(df: DataFrame, keys, order: str = ORDER, keep_order: bool = False) -> DataFrame:
    """Last write wins per key: the row with the greatest ``order`` per key.

    ``groupBy(keys).agg(max(struct(order, row...)))``: struct comparison looks at
    ``order`` first (the rest only breaks exact ties, deterministically).  It is a
    partial-then-final aggregate, so a hot key is pre-reduced on the map side
    before the shuffle.  A ``first_load_dt`` column (hubs) is not overwritten but
    kept as the minimum over all loads of the key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys and c not in (order, FIRST_SEEN)]
    aggs = [F.max(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("_w")]
    first = FIRST_SEEN in df.columns
    if first:
        aggs.append(F.min(FIRST_SEEN).alias(FIRST_SEEN))
    agg = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys] + [F.col(f"_w.{c}").alias(c) for c in rest]
    if first:
        cols.append(F.col(FIRST_SEEN))
    if keep_order:
        cols.append(F.col(f"_w.{order}").alias(order))
    return agg.select(*cols)


def loaded_targets(model: VaultModel, src: SourceTable) -> list[TargetTable]:
    """The vault tables a topic actually loads (links the model marks ``load: false`` skip)."""
    return [t for t in model.plan_table(src)
            if not (t.kind == "link" and not all(r.load or model.load_all for r in t.refs))]


def load_topic(decoded: DataFrame, model: VaultModel, src: SourceTable, batch_id=0,
               coercion: str = "typed", dedup: bool = True) -> dict[str, DataFrame]:
    """Fan one topic's good events out to every vault table it feeds.

    Order: hub, links, satellite (history tables alone).  Keyed tables are
    deduplicated by key inside the batch (``dedup``), so repeats in one batch
    never reach storage; ``_order`` is kept for the cross-batch keyed read.
    """
    out: dict[str, DataFrame] = {}
    for t in loaded_targets(model, src):
        if dedup and t.unique_key:
            out[t.name] = last_rows(decoded, src, t, batch_id, coercion, keep_order=True)
        else:
            out[t.name] = target_rows(decoded, src, t, batch_id, coercion)
    return out


def conform(df: DataFrame, target: TargetTable) -> DataFrame:
    """Keep the target's columns in its order, cast by the type map; absent -> NULL."""
    have = set(df.columns)
    cols = []
    for name, typ, _nullable in target.columns:
        c = F.col(name).try_cast(typ) if name in have else F.lit(None).cast(typ)
        cols.append(c.alias(name))
    return df.select(*cols)


def drop_technical(df: DataFrame) -> DataFrame:
    from ..model import TECHNICAL
    return df.drop(*TECHNICAL)


def with_vault_meta(df: DataFrame, record_source: str | Column, load_dt: Column) -> DataFrame:
    """Add load_dt and record_source (passed in, never read from the clock)."""
    rs = record_source if isinstance(record_source, Column) else F.lit(record_source)
    return df.withColumn("load_dt", load_dt.cast("timestamp_ntz")).withColumn("record_source", rs)


def latest_rows(df: DataFrame, k: int = 5, order_col: str = "load_dt", tie_break=()) -> DataFrame:
    """ORDER BY load_dt DESC LIMIT k with key tie-break (a top-k: TakeOrderedAndProject)."""
    return df.orderBy(F.col(order_col).desc(), *[F.col(c).asc() for c in tie_break]).limit(k)
