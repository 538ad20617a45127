"""Scalar expressions."""
import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from costlake.functions import (
    allocate_even, is_masked, mask_email, month_key, pct_change, redact_phone, week_key,
)
from costlake.functions.masking import check_salt, email_is_valid, phone_is_valid


def test_mask_email_vector(spark):
    df = spark.createDataFrame([("user@example.com",), ("  USER@Example.com\t",), ("\tuser@example.com ",)], "e string")
    out = [r[0] for r in df.select(mask_email("e", "test-salt")).collect()]
    assert set(out) == {"bb2dbabc157ff9bfb72106e0bb9ae6114b9b69cf8097f68bf08a8f3c726e469a"}
    assert out[0] == hashlib.sha256(b"user@example.comtest-salt").hexdigest()


def test_mask_email_validity(spark):
    df = spark.createDataFrame([("",), ("no-at-sign",), (None,), ("a@b",)], "e string")
    assert [r[0] for r in df.select(email_is_valid("e")).collect()] == [False, False, False, True]


@pytest.mark.parametrize("phone", ["555-123-4567", "+1 (555) 123-4567", "5551234567"])
def test_redact_phone(spark, phone):
    df = spark.createDataFrame([(phone,)], "p string")
    assert df.select(redact_phone("p")).first()[0] == "XXX-XXX-4567"


def test_phone_too_short(spark):
    df = spark.createDataFrame([("12",), ("1-2-3-4",)], "p string")
    assert [r[0] for r in df.select(phone_is_valid("p")).collect()] == [False, True]


def test_empty_salt():
    with pytest.raises(ValueError):
        check_salt("")
    with pytest.raises(ValueError):
        mask_email("e", "")


def test_is_masked(spark):
    token = "a" * 64
    df = spark.createDataFrame([(token, "XXX-XXX-1234"), ("x@y.z", "555-1234")], "e string, p string")
    got = df.select(is_masked("e", "email"), is_masked("p", "phone"), is_masked("p", "other")).collect()
    assert [tuple(r) for r in got] == [(True, True, False), (False, False, False)]


def test_week_key_matches_strftime(spark):
    start = dt.date(1994, 12, 20)
    days = [start + dt.timedelta(days=i) for i in range(2600)]
    df = spark.createDataFrame([(d.isoformat(),) for d in days], "d string")
    got = [r[0] for r in df.select(week_key("d")).collect()]
    assert got == [d.strftime("%Y-W%W") for d in days]


def test_week_key_year_boundary(spark):
    df = spark.createDataFrame([(f"2024-12-{d}",) for d in (30, 31)] + [(f"2025-01-0{d}",) for d in range(1, 7)], "d string")
    got = [r[0] for r in df.select(week_key("d")).collect()]
    assert got == ["2024-W53", "2024-W53", "2025-W00", "2025-W00", "2025-W00", "2025-W00", "2025-W00", "2025-W01"]


def test_week_key_rejects_time_part(spark):
    df = spark.createDataFrame([("2025-01-01T10:00:00",)], "d string")
    with pytest.raises(Exception):
        df.select(week_key("d")).collect()


def test_month_key(spark):
    assert spark.createDataFrame([("2025-03-09",)], "d string").select(month_key("d")).first()[0] == "2025-03"


def test_pct_change_zero_previous(spark):
    df = spark.createDataFrame([(0, 0), (5, 0), (-5, 0), (12, 10), (None, 3), (3, None)], "c int, p int")
    df = df.select(F.col("c").cast("decimal(38,6)").alias("c"), F.col("p").cast("decimal(38,6)").alias("p"))
    got = [r[0] for r in df.select(pct_change("c", "p")).collect()]
    assert math.isnan(got[0]) and got[1] == math.inf and got[2] == -math.inf
    assert got[3] == pytest.approx(0.2) and got[4] is None and got[5] is None


def test_allocate_even_matches_integer_cents(spark):
    rng = random.Random(7)
    cases = [(rng.randint(-500000, 5000000), rng.choice([1, 2, 3, 7, 8, 30, 9999, 10001, 15000, 123457]))
             for _ in range(3000)] + [(116, 8), (5, 2), (-5, 2), (0, 3), (1, 20000)]
    df = spark.createDataFrame(cases, "cents long, n long").select(
        "cents", "n", (F.col("cents").cast("decimal(38,2)") / 100).cast("decimal(38,2)").alias("total"))
    got = {(r.cents, r.n): r.a for r in df.select("cents", "n", allocate_even("total", "n").alias("a")).collect()}

    def half_up(c, n):
        q = (2 * abs(c) + n) // (2 * n)
        return q if c >= 0 else -q
    for c, n in cases:
        assert int(got[(c, n)] * 100) == half_up(c, n), (c, n)
