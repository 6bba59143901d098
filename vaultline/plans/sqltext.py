"""Small helpers that write DuckDB SQL text for the oracles."""

from __future__ import annotations


def round_div_sql(num_int: str, den: str, digits: int = 2) -> str:
    """round(num/den, digits) half away from zero with exact integer arithmetic.

    ``num_int`` must already be an integer expression scaled to 10**digits units.
    """
    n = f"CAST({num_int} AS HUGEINT)"
    d = f"CAST(NULLIF({den}, 0) AS HUGEINT)"
    q = f"(sign({n}) * ((abs({n}) * 2 + abs({d})) // (2 * abs({d}))))"
    unit = f"CAST('{1 / 10 ** digits:.{digits}f}' AS DECIMAL({digits + 1},{digits}))"
    exact = f"CAST(CAST({q} AS DECIMAL(36,0)) * {unit} AS DECIMAL(38,{digits}))"
    return f"CAST(CAST({exact} AS VARCHAR) AS DOUBLE)"


def pct_sql(part: str, whole: str) -> str:
    return round_div_sql(f"({part}) * 10000", whole, 2)


def md5_json_sql(pairs: list[tuple[str, str]]) -> str:
    """md5 of Python-style sorted JSON for ASCII attributes.

    pairs: (name, sql_expr_already_json_text) -- the caller quotes strings.
    """
    items = sorted(pairs)
    parts = []
    for i, (name, expr) in enumerate(items):
        sep = "" if i == 0 else ", "
        parts.append(f"'{sep}\"{name}\": ' || COALESCE({expr}, 'null')")
    return "md5('{' || " + " || ".join(parts) + " || '}')"


def json_str_sql(expr: str) -> str:
    """An ASCII string as a JSON literal (quote and backslash escaped)."""
    return ("('\"' || replace(replace(" + expr + ", '\\', '\\\\'), '\"', '\\\"') || '\"')")
