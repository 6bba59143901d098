"""Column expressions (built-in Spark functions only, no Python UDFs)."""

from .dates import add_months, month_trunc, period_num, epoch_millis, from_epoch_millis, from_epoch_days, epoch_days
from .numeric import round_div, pct, to_money
from .hashing import hub_hash, link_hash, hash_diff, json_string_literal, json_value
from .coerce import coerce_typed, coerce_compat, cast_to, vault_type

__all__ = [
    "add_months", "month_trunc", "period_num", "epoch_millis", "from_epoch_millis",
    "from_epoch_days", "epoch_days", "round_div", "pct", "to_money", "hub_hash", "link_hash",
    "hash_diff", "json_string_literal", "json_value", "coerce_typed", "coerce_compat",
    "cast_to", "vault_type",
]
