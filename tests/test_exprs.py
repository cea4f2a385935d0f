import decimal
import hashlib
import math
import random
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entity360.functions import (
    any_flag,
    blank_to_null,
    exact_sum,
    full_name,
    lowest_of,
    membership_label,
    membership_state,
    merge_money,
    money_gap,
    money_value,
    normalise_status,
    surrogate_key,
    times_money,
)

AS_OF = date(2024, 6, 15)


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (_, t) in values.items())
    row = tuple(v for v, _ in values.values())
    df = spark.createDataFrame([row], schema) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_surrogate_key_keeps_place_of_null_parts(spark):
    key = surrogate_key(F.lit("m"), F.col("a"), F.col("b"), F.col("d"))
    got = one(spark, key, a=(None, "string"), b=(7, "bigint"), d=(date(2024, 1, 2), "date"))
    assert got == hashlib.sha256(b"m||7|2024-01-02").hexdigest()


def test_surrogate_key_does_not_escape_the_bar(spark):
    a = one(spark, surrogate_key(F.lit("a|b"), F.lit("c")))
    assert a == one(spark, surrogate_key(F.lit("a"), F.lit("b|c")))


def test_full_name(spark):
    def name(first, last):
        return one(
            spark, full_name(F.col("a"), F.col("b")), a=(first, "string"), b=(last, "string")
        )

    assert name("Ada", "Lovelace") == "Ada Lovelace"
    assert name(None, "Lovelace") == "Lovelace"
    assert name("Ada", None) == "Ada"
    assert name(None, None) is None
    assert name("\t", " ") is None


def test_blank_to_null_keeps_white_space(spark):
    assert one(spark, blank_to_null(F.lit(""))) is None
    assert one(spark, blank_to_null(F.lit(" "))) == " "


def test_normalise_status(spark):
    def status(raw):
        known = ("won", "lost", "open")
        return one(spark, normalise_status(F.col("s"), known), s=(raw, "string"))

    assert [status(s) for s in ("won", "Won", "other", None)] == ["won"] + ["unknown"] * 3


def test_membership_state(spark):
    def state(raw, start, end):
        column = membership_state(F.col("r"), F.col("s"), F.col("e"), AS_OF)
        return one(spark, column, r=(raw, "string"), s=(start, "date"), e=(end, "date"))

    past, future = date(2024, 1, 1), date(2025, 1, 1)
    assert state("active", past, past) == "active"
    assert state("paused", past, past) == "expired"
    assert state("paused", future, None) == "not_started"
    assert state("paused", past, None) == "paused"
    assert state(None, AS_OF, AS_OF) == "unknown"
    assert state("paused", future, past) == "expired"


def test_membership_label(spark):
    def label(n, history):
        column = membership_label(F.col("n"), F.col("h"))
        return one(spark, column, n=(n, "bigint"), h=(history, "boolean"))

    assert label(1, True) == "active_member"
    assert label(0, True) == "former_member"
    assert label(None, False) == "no_membership_record"


def test_lowest_and_flags_skip_nulls(spark):
    kinds = {"a": (None, "double"), "b": (0.5, "double"), "c": (0.7, "double")}
    assert one(spark, lowest_of(F.col("a"), F.col("b"), F.col("c")), **kinds) == 0.5
    nothing = {"a": (None, "double"), "b": (None, "double")}
    assert one(spark, lowest_of(F.col("a"), F.col("b")), **nothing) is None
    flags = {"a": (None, "boolean"), "b": (True, "boolean")}
    assert one(spark, any_flag(F.col("a"), F.col("b")), **flags) is True
    assert one(spark, any_flag(F.col("a"), F.col("a")), **flags) is False


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.none() | st.text(max_size=5), st.none() | st.integers(-9, 9)), min_size=1, max_size=8))
def test_surrogate_key_depends_on_parts_only(spark, rows):
    df = spark.createDataFrame(rows, "a string, b bigint")
    got = [r["k"] for r in df.select(surrogate_key(F.col("a"), F.col("b")).alias("k")).collect()]
    texts = [f"{'' if a is None else a}|{'' if b is None else b}" for a, b in rows]
    assert got == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


@pytest.mark.parametrize(
    "amounts",
    [
        [5.0, float("nan")],
        [5.0, float("inf")],
        [5.0, float("-inf")],
        [float("inf"), float("-inf")],
        [1e20, 1.0],
        [1e20, -1e20],
        [-1e20, 2.5, None],
        [1e-10, 2e-10],
        [0.1] * 10,
        [0.0, -0.0],
        [None, None],
        [],
    ],
)
@pytest.mark.parametrize("copies", [1, 3])
def test_no_amount_is_lost_in_a_total(spark, amounts, copies):
    rows = spark.createDataFrame([(a,) for a in amounts], "amount double").repartition(3)
    parts = rows.groupBy(F.spark_partition_id().alias("part")).agg(
        exact_sum(F.col("amount")).alias("total")
    )
    merged = parts.agg(merge_money(F.col("total")).alias("total"))
    got = merged.select(money_value(times_money(F.col("total"), F.lit(copies))).alias("x")).first().x
    known = [a for a in amounts if a is not None]
    if not known:
        assert got is None
    elif math.isnan(sum(known)):
        assert math.isnan(got)
    else:
        assert got == pytest.approx(sum(known) * copies, rel=1e-12)


def test_a_total_too_large_for_a_decimal_times_its_copies(spark):
    rows = spark.range(40).select(F.lit(9.9e18).alias("amount"))
    total = rows.agg(exact_sum(F.col("amount")).alias("total"))
    got = total.select(money_value(times_money(F.col("total"), F.lit(2))).alias("x")).first().x
    assert got == pytest.approx(9.9e18 * 80)


def test_gaps_of_money_are_exact_where_they_can_be(spark):
    rows = spark.createDataFrame([(0.3, 0.1), (1e20, 1.0), (float("nan"), 1.0)], "a double, b double")
    got = [r.x for r in rows.select(money_gap(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got[:2] == [0.2, 1e20] and math.isnan(got[2])


def test_totals_hold_what_the_amounts_are_as_decimals(spark):
    """Each amount alone against Spark's own cast, and all together against Python's decimals."""
    rng = random.Random(4)
    amounts = [0.1, -0.1, 0.0015, 123.4567890125, 846.7292000000001, 4194303.9999999995, 8388608.1, 1e8 + 0.1, 99999999999.9999]
    amounts += [1e15 + 0.3, -9.999999999e18, 2.0**53, 4.5e15 + 0.5, 12345678.123456789, 0.0010000005, 262144.0000000005]
    amounts += [round(rng.uniform(-1e7, 1e7), rng.randint(0, 12)) for _ in range(300)]
    amounts += [rng.uniform(-1, 1) * 10 ** rng.randint(-2, 18) for _ in range(300)]
    amounts += [rng.randint(1, 10**9) / 3 for _ in range(100)]
    amounts = [a for a in amounts if abs(a) >= 1e-3]
    rows = spark.createDataFrame(list(enumerate(amounts)), "i int, amount double").repartition(3)
    each = rows.groupBy("i").agg(
        exact_sum(F.col("amount")).alias("t"), F.first(F.col("amount").cast("decimal(28,9)")).alias("want")
    )
    with decimal.localcontext(decimal.Context(prec=60)):
        total = decimal.Decimal(0)
        for r in each.collect():
            got = decimal.Decimal(r.t.giga * 10**9 + r.t.whole) + decimal.Decimal(r.t.nano).scaleb(-9)
            assert got == r.want, amounts[r.i]
            total += r.want
    whole = rows.agg(exact_sum(F.col("amount")).alias("t"))
    assert whole.select(money_value(F.col("t")).alias("x")).first().x == float(total)
    rounded = whole.select(money_value(F.col("t"), 2).alias("x")).first().x
    assert rounded == pytest.approx(float(total), rel=1e-15)


def test_totals_are_sums_of_longs(spark):
    rows = spark.range(9).select((F.col("id") / 7).alias("amount"))
    plan = rows.agg(exact_sum(F.col("amount")).alias("t"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "decimal(38" not in plan
    assert rows.agg(exact_sum(F.col("amount")).alias("t")).dtypes == [
        ("t", "struct<giga:bigint,whole:bigint,nano:bigint,rest:double>")
    ]
