"""Deterministic vault keys and content hashes as native column expressions.

* hub key: lowercase hex MD5 of the business key text, no trim or salt;
* link key: MD5 of the two hub keys concatenated, no delimiter, in the
  configured direction;
* hash_diff: MD5 of the attribute dict serialised the way Python's default
  ``json.dumps(d, sort_keys=True)`` does it: keys sorted, ``": "`` and ``", "``
  separators, NULL as ``null``, every character outside space..tilde escaped as
  ``\\uXXXX`` (lowercase hex, UTF-16 surrogate pairs).  ``to_json`` differs on
  all of these, so the text is assembled from built-in string functions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hub_hash(bk) -> Column:
    """MD5 of the business key's text."""
    return F.md5(_c(bk).cast("string"))


def link_hash(source_hk, target_hk) -> Column:
    """MD5 of source hub key || target hub key."""
    return F.md5(F.concat(_c(source_hk), _c(target_hk)))


def json_string_literal(c) -> Column:
    """A string value as a JSON literal with Python's ASCII escaping.

    Plain printable ASCII without quote or backslash (the common case) is
    tested with one ``rlike`` and passed through; only the rest goes through
    the escape chain.
    """
    raw = _c(c).cast("string")
    s = F.regexp_replace(raw, r'(["\\])', r'\\$1')
    # Named escapes; the rest of the control range falls to \u00XX below.
    s = F.regexp_replace(s, "\n", r"\\n")
    s = F.regexp_replace(s, "\r", r"\\r")
    s = F.regexp_replace(s, "\t", r"\\t")
    s = F.regexp_replace(s, "\x08", r"\\b")
    s = F.regexp_replace(s, "\x0c", r"\\f")
    per_char = F.array_join(F.transform(
        F.split(s, ""),
        lambda x: F.when(F.ascii(x).between(32, 126), x).otherwise(
            F.lower(F.regexp_replace(F.hex(F.encode(x, "UTF-16BE")), "(.{4})", r"\\u$1")))),
        "")
    escaped = F.when(s.rlike("[^ -~]"), per_char).otherwise(s)
    plain = ~raw.rlike(r'[^ -~]|["\\]')
    return F.concat(F.lit('"'), F.when(plain, raw).otherwise(escaped), F.lit('"'))


def json_value(c, wire_kind: str) -> Column:
    """One wire value as JSON text; NULL becomes ``null``.

    wire_kind: ``string`` (also decimals, uuids, inet: strings on the wire),
    ``int`` (ints, epoch days, epoch millis) or ``bool``.
    """
    col = _c(c)
    if wire_kind == "string":
        text = json_string_literal(col)
    elif wire_kind == "int":
        text = col.cast("bigint").cast("string")
    elif wire_kind == "bool":
        text = F.when(col, F.lit("true")).when(~col, F.lit("false"))
    else:
        raise ValueError(f"unsupported wire kind {wire_kind!r}")
    return F.coalesce(text, F.lit("null"))


def canonical_json(values: Iterable[tuple[str, Column, str]]) -> Column:
    """``json.dumps({name: value}, sort_keys=True)`` for (name, column, wire_kind)."""
    items = sorted(values, key=lambda t: t[0])
    parts: list[Column] = [F.lit("{")]
    for i, (name, col, kind) in enumerate(items):
        key = ('"' + name + '": ') if i == 0 else (', "' + name + '": ')
        parts += [F.lit(key), json_value(col, kind)]
    parts.append(F.lit("}"))
    return F.concat(*parts)


def hash_diff(values: Iterable[tuple[str, Column, str]]) -> Column:
    """MD5 of the canonical JSON of the raw wire attribute values."""
    return F.md5(canonical_json(values))
