"""The vault model: source tables, their change topics and the vault tables they feed.

Classification of a source table (``plan_table``):

* it has a business key -> hub ``hub_<name>``; a satellite ``sat_<name>`` if it
  has attributes (technical columns dropped); one link
  ``lnk_<name>_<target>`` per reference;
* no business key and one reference -> an append-only history satellite
  ``sat_<name>`` keyed by the referenced hub;
* no business key and several references -> a link ``lnk_<name>`` over all
  referenced hubs, plus a satellite on that link if it has attributes;
* no key and no reference -> nothing.

Everything here is driver-side configuration; the data work happens in
``vaultline.operators.vault`` on executors.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from functools import cached_property

import yaml
from pyspark.sql import types as T

from ..functions.coerce import vault_type, wire_kind, wire_type

# Columns of operational tables that are bookkeeping, not business content;
# dropped from hub satellites only.
TECHNICAL = ("effective_from", "effective_to", "is_current",
             "created_at", "updated_at", "created_by", "updated_by")

_SPARK = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
          "boolean": T.BooleanType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
          "decimal(18,2)": T.DecimalType(18, 2)}

DEFAULT_MODEL = os.path.join(os.path.dirname(__file__), "marketplace.yaml")


@dataclass(frozen=True)
class Attr:
    name: str
    declared: str

    @property
    def vault_type(self) -> str:
        return vault_type(self.declared)

    @property
    def wire_type(self) -> str:
        return wire_type(self.declared)

    @property
    def wire_kind(self) -> str:
        return wire_kind(self.declared)


@dataclass(frozen=True)
class Reference:
    target: str
    field: str
    load: bool = True


@dataclass(frozen=True)
class TargetTable:
    name: str
    kind: str                      # hub | link | sat | history
    source: str                    # source table name
    columns: tuple                 # ((name, spark type, nullable), ...)
    unique_key: tuple              # key columns; () for append-only (duplicate key) tables
    distribute_by: str
    attrs: tuple = ()              # (Attr, ...) loaded attributes of a satellite
    refs: tuple = ()               # (Reference, ...) hubs joined by a link

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, _SPARK[t], nullable) for n, t, nullable in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c[0] for c in self.columns]


@dataclass(frozen=True)
class SourceTable:
    name: str
    service: str
    business_key: Attr | None
    references: tuple
    attributes: tuple              # all declared attributes (Attr)
    load: tuple                    # names of attributes the loader writes

    @property
    def topic(self) -> str:
        return f"{self.service}.public.{self.name}"

    @property
    def kind(self) -> str:
        if self.business_key is not None:
            return "hub"
        if len(self.references) == 1:
            return "history"
        if len(self.references) > 1:
            return "link"
        return "none"

    def attr(self, name: str) -> Attr:
        for a in self.attributes:
            if a.name == name:
                return a
        raise KeyError(f"{self.name}.{name}")

    @property
    def wire_fields(self) -> list[Attr]:
        """Every field a change event of this table may carry (wire typed)."""
        out: dict[str, Attr] = {}
        if self.business_key is not None:
            out[self.business_key.name] = Attr(self.business_key.name, "varchar")
        for r in self.references:
            out.setdefault(r.field, Attr(r.field, "varchar"))
        for a in self.attributes:
            out.setdefault(a.name, a)
        return list(out.values())

    @property
    def wire_schema(self) -> T.StructType:
        return T.StructType([T.StructField(a.name, _SPARK[a.wire_type], True) for a in self.wire_fields])


def hk(name: str) -> str:
    return f"hk_{name}"


_META = (("load_dt", "timestamp_ntz", False), ("record_source", "string", False))


@dataclass
class VaultModel:
    tables: dict = field(default_factory=dict)   # name -> SourceTable
    buckets: int = 4
    load_all: bool = False

    @classmethod
    def load(cls, path: str = DEFAULT_MODEL, **overrides) -> "VaultModel":
        with open(path, encoding="utf-8") as f:
            doc = yaml.safe_load(f)
        settings = dict(doc.get("settings", {}))
        settings.update(overrides)
        tables = {}
        for t in doc["tables"]:
            bk = t.get("business_key")
            tables[t["name"]] = SourceTable(
                name=t["name"], service=t["service"],
                business_key=Attr(bk["name"], bk.get("type", "varchar")) if bk else None,
                references=tuple(Reference(r["target"], r["field"], r.get("load", True))
                                 for r in t.get("references", [])),
                attributes=tuple(Attr(n, ty) for n, ty in (t.get("attributes") or {}).items()),
                load=tuple(t.get("load", [])),
            )
        return cls(tables=tables, buckets=int(settings.get("buckets", 4)),
                   load_all=bool(settings.get("load_all", False)))

    # ------------------------------------------------------------ lookups
    def source(self, name_or_topic: str) -> SourceTable:
        if name_or_topic in self.tables:
            return self.tables[name_or_topic]
        for t in self.tables.values():
            if t.topic == name_or_topic:
                return t
        raise KeyError(name_or_topic)

    @property
    def topics(self) -> list[str]:
        return [t.topic for t in self.tables.values()]

    def topics_of(self, service: str) -> list[str]:
        return [t.topic for t in self.tables.values() if t.service == service]

    def loaded_attrs(self, src: SourceTable, technical_dropped: bool) -> tuple:
        names = [a.name for a in src.attributes] if self.load_all else list(src.load)
        if technical_dropped:
            names = [n for n in names if n not in TECHNICAL]
        return tuple(src.attr(n) for n in names)

    def target_attrs(self, src: SourceTable, technical_dropped: bool) -> tuple:
        if technical_dropped:
            return tuple(a for a in src.attributes if a.name not in TECHNICAL)
        return tuple(src.attributes)

    # ------------------------------------------------------------ classification
    def plan_table(self, src: SourceTable) -> list[TargetTable]:
        """The vault tables a source table feeds, in load order."""
        out: list[TargetTable] = []
        kind = src.kind
        if kind == "hub":
            key = hk(src.name)
            out.append(TargetTable(
                f"hub_{src.name}", "hub", src.name,
                ((key, "string", False), (src.business_key.name, "string", False)) + _META
                + (("first_load_dt", "timestamp_ntz", True),),
                (key,), key))
            for r in src.references:
                lnk = f"lnk_{src.name}_{r.target}"
                out.append(TargetTable(
                    lnk, "link", src.name,
                    ((hk(lnk), "string", False), (key, "string", False), (hk(r.target), "string", False)) + _META,
                    (hk(lnk),), hk(lnk), refs=(r,)))
            if src.attributes:
                cols = tuple((a.name, a.vault_type, True) for a in self.target_attrs(src, True))
                out.append(TargetTable(
                    f"sat_{src.name}", "sat", src.name,
                    ((key, "string", False), ("hash_diff", "string", False)) + _META + cols,
                    (key, "hash_diff"), key, attrs=self.loaded_attrs(src, True)))
        elif kind == "history":
            r = src.references[0]
            key = hk(r.target)
            cols = tuple((a.name, a.vault_type, True) for a in self.target_attrs(src, False))
            out.append(TargetTable(
                f"sat_{src.name}", "history", src.name,
                ((key, "string", False), ("load_dt", "timestamp_ntz", False), ("hash_diff", "string", False),
                 ("record_source", "string", False)) + cols,
                (), key, attrs=self.loaded_attrs(src, False), refs=(r,)))
        elif kind == "link":
            lnk = f"lnk_{src.name}"
            out.append(TargetTable(
                lnk, "link", src.name,
                ((hk(lnk), "string", False),) + tuple((hk(r.target), "string", False) for r in src.references)
                + _META,
                (hk(lnk),), hk(lnk), refs=src.references))
            if src.attributes:
                cols = tuple((a.name, a.vault_type, True) for a in self.target_attrs(src, False))
                out.append(TargetTable(
                    f"sat_{src.name}", "sat", src.name,
                    ((hk(lnk), "string", False), ("hash_diff", "string", False)) + _META + cols,
                    (hk(lnk), "hash_diff"), hk(lnk), attrs=self.loaded_attrs(src, False),
                    refs=src.references))
        return out

    @cached_property
    def targets(self) -> dict:
        out = {}
        for src in self.tables.values():
            for t in self.plan_table(src):
                out[t.name] = t
        return out

    def target(self, name: str) -> TargetTable:
        return self.targets[name]
