"""Column functions against Python references: exact rounding, calendar, wire conversions."""

import pytest

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from vaultline.functions.dates import (epoch_days, epoch_millis, from_epoch_days, from_epoch_millis,
                                       month_trunc, period_num)
from vaultline.functions.numeric import pct, round_div


def test_round_div_exact_for_large_and_negative_values(spark):
    rnd = random.Random(11)
    rows = []
    for _ in range(400):
        den = rnd.choice([1, 2, 3, 7, 8, 16, 800, 10 ** 7 + 3, 3 * 10 ** 11 + 1])
        num = rnd.randint(-10 ** 15, 10 ** 15) if rnd.random() < 0.5 else rnd.randint(0, den)
        rows.append((num, den))
    rows += [(1, 8), (3, 8), (5, 200), (-5, 200), (10 ** 13 + 5, 10 ** 12 * 2)]
    df = spark.createDataFrame(rows, "n long, d long")
    got = [r[0] for r in df.select(round_div("n", "d", 2)).collect()]
    want = [float((Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for n, d in rows]
    assert got == want


def test_pct_matches_decimal_for_all_small_cohorts(spark):
    rows = [(a, s) for s in range(1, 121) for a in range(0, s + 1)]
    df = spark.createDataFrame(rows, "a long, s long")
    got = [r[0] for r in df.select(pct("a", "s")).collect()]
    want = [float((Decimal(a * 100) / Decimal(s)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for a, s in rows]
    assert got == want


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(5, 0), (5, None)], "n long, d long")
    assert [r[0] for r in df.select(round_div("n", "d")).collect()] == [None, None]


def test_calendar_and_wire_round_trips(spark):
    ts = [dt.datetime(1969, 12, 31, 23, 59, 59, 999000), dt.datetime(1970, 1, 1), dt.datetime(2001, 9, 9, 1, 46, 40),
          dt.datetime(2020, 2, 29, 12, 0, 0, 123000), dt.datetime(2024, 12, 31, 23, 59, 59)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    out = df.select(epoch_millis("t").alias("ms"), epoch_days("t").alias("d"), month_trunc("t").alias("m"),
                    from_epoch_millis(epoch_millis("t")).alias("back"),
                    from_epoch_days(epoch_days("t")).alias("day")).collect()
    epoch = dt.datetime(1970, 1, 1)
    for t, r in zip(ts, out):
        assert r["ms"] == (t - epoch) // dt.timedelta(milliseconds=1)
        assert r["back"] == t
        assert r["d"] == (t.date() - epoch.date()).days and r["day"] == t.date()
        assert r["m"] == dt.datetime(t.year, t.month, 1)
    assert epoch_millis  # 2001-09-09 01:46:40 is exactly 10**12 ms
    assert out[2]["ms"] == 10 ** 12


def test_period_num_is_age_months_modulo_12(spark):
    pairs = [(dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1)), (dt.datetime(2020, 12, 1), dt.datetime(2021, 1, 1)),
             (dt.datetime(2019, 3, 1), dt.datetime(2020, 3, 1)), (dt.datetime(2019, 3, 1), dt.datetime(2020, 5, 1)),
             (dt.datetime(2020, 5, 1), dt.datetime(2020, 3, 1))]
    df = spark.createDataFrame(pairs, "c timestamp_ntz, a timestamp_ntz")
    assert [r[0] for r in df.select(period_num("a", "c")).collect()] == [0, 1, 0, 2, -2]
    assert df.select(from_epoch_days(F.lit(10 ** 9))).first()[0] is None


def test_declared_types(spark):
    """A decimal keeps the precision that the model gives it; types that the map doesn't know are refused."""
    from vaultline.functions import coerce as K
    assert K.vault_type("decimal") == "decimal(18,2)" and K.vault_type("Decimal(9, 6)") == "decimal(9,6)"
    assert K.sql_type("DECIMAL(9,6)") == "DECIMAL(9,6)" and K.vault_type("inet") == "string"
    for unknown in ("point", "decimal(9)", "varchar2", ""):
        with pytest.raises(ValueError, match="unknown source type"):
            K.sql_type(unknown)
    got = spark.createDataFrame([("55.755811",), ("x",)], "v string").select(K.coerce_typed("v", "decimal(9,6)").alias("v")).collect()
    assert [str(r["v"]) for r in got] == ["55.755811", "None"]
