"""Wire-value coercion and vault typing.

Wire form (change-event connector settings): dates are int days since the
epoch, timestamps are bigint milliseconds, decimals are strings, the rest is
plain JSON.  ``coerce_typed`` converts by *declared* type; ``coerce_compat``
reproduces the reference loader's guess (large ints are microseconds, ints in
columns named like dates are days), kept for parity checks only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import from_epoch_days, from_epoch_millis

# Fixed values that must equal the reference's: source type -> vault column type
# (unknown types fall back to the varchar mapping; lookup is case-insensitive).
#   uuid      -> VARCHAR(36)
#   varchar   -> VARCHAR(500)
#   text      -> VARCHAR(65533)
#   integer   -> INT
#   serial    -> INT
#   decimal   -> DECIMAL(18,2)
#   boolean   -> BOOLEAN
#   date      -> DATE
#   timestamp -> DATETIME
#   inet      -> VARCHAR(50)
VAULT_SQL_TYPE = {
    "uuid": "VARCHAR(36)",
    "varchar": "VARCHAR(500)",
    "text": "VARCHAR(65533)",
    "integer": "INT",
    "serial": "INT",
    "decimal": "DECIMAL(18,2)",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "DATETIME",
    "inet": "VARCHAR(50)",
}

# The same map in Spark types, plus the wire type each declared type arrives as.
_SPARK_TYPE = {
    "VARCHAR(36)": "string", "VARCHAR(500)": "string", "VARCHAR(65533)": "string",
    "VARCHAR(50)": "string", "INT": "int", "DECIMAL(18,2)": "decimal(18,2)",
    "BOOLEAN": "boolean", "DATE": "date", "DATETIME": "timestamp_ntz",
}
_WIRE = {
    "integer": ("bigint", "int"), "serial": ("bigint", "int"), "boolean": ("boolean", "bool"),
    "date": ("bigint", "int"), "timestamp": ("bigint", "int"),
}

# Maximum length per VARCHAR vault type, for the over-length flag (T10).
VARCHAR_LIMIT = {"VARCHAR(36)": 36, "VARCHAR(500)": 500, "VARCHAR(65533)": 65533, "VARCHAR(50)": 50}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_type(declared: str) -> str:
    """The vault type of a declared source type; ``decimal(p,s)`` keeps its precision, an unknown type is refused."""
    t = declared.lower().replace(" ", "")
    if re.fullmatch(r"decimal\(\d{1,2},\d{1,2}\)", t):
        return t.upper()
    if t not in VAULT_SQL_TYPE:
        raise ValueError(f"unknown source type {declared!r}")
    return VAULT_SQL_TYPE[t]


def vault_type(declared: str) -> str:
    """Spark type name of the vault column for a declared source type."""
    t = sql_type(declared)
    return t.lower() if t.startswith("DECIMAL") else _SPARK_TYPE[t]


def wire_type(declared: str) -> str:
    """Spark type of the JSON wire value for a declared source type."""
    return _WIRE.get(declared.lower(), ("string", "string"))[0]


def wire_kind(declared: str) -> str:
    """JSON kind of the wire value: string, int or bool (see hashing.json_value)."""
    return _WIRE.get(declared.lower(), ("string", "string"))[1]


def coerce_typed(c, declared: str) -> Column:
    """Wire value -> vault value by declared type; unparsable values become NULL."""
    col = _c(c)
    t = declared.lower()
    if t == "date":
        return from_epoch_days(col)
    if t == "timestamp":
        return from_epoch_millis(col)
    return cast_to(col, vault_type(declared))


def cast_to(c, spark_type: str) -> Column:
    """Cast to a vault type without failing the job (bad values -> NULL)."""
    return _c(c).try_cast(spark_type)


def coerce_compat(c, attr_name: str, declared: str) -> Column:
    """The reference loader's guess, typed into the target column.

    An integer above 10**12 is read as *microseconds* (so connector millis land in
    January 1970); otherwise, an integer in a column whose name contains
    ``date`` or ``birth`` is read as days.  Anything the target type cannot hold
    becomes NULL, which the quarantine step reports.
    """
    col = _c(c)
    target = vault_type(declared)
    t = declared.lower()
    if t not in ("date", "timestamp", "integer", "serial"):
        return cast_to(col, target)
    big = col.cast("bigint")
    as_micros = F.timestamp_add("MICROSECOND", big, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    name_is_date = any(k in attr_name for k in ("date", "birth"))
    as_days = from_epoch_days(big) if name_is_date else F.lit(None).cast("date")
    if target == "timestamp_ntz":
        return F.when(big > 10 ** 12, as_micros).otherwise(as_days.cast("timestamp_ntz"))
    if target == "date":
        return F.when(big > 10 ** 12, as_micros.cast("date")).otherwise(as_days)
    # integer targets: a value taken for a time cannot be stored in an INT column
    return F.when((big > 10 ** 12) | F.lit(name_is_date), F.lit(None)).otherwise(big).cast(target)
