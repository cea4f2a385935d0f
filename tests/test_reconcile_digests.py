"""Digests before the full join: nothing is lost, and rows of equal buckets are not joined."""

import pytest
from pyspark.sql import functions as F

from entity360.operators import reconcile
from entity360.operators.reconcile import (
    MEMBERSHIP_KEYS,
    MEMBERSHIP_MEASURES,
    full_reconcile,
    reconcile_mismatches,
    reconcile_summary,
    split_by_digest,
)

SCHEMA = (
    "month_start string, company_id string, location_id string, membership_category string, plan_id string, "
    "active_memberships bigint, active_members bigint, total_mrr double, total_calculated_list_price double, "
    "total_calculated_discount_amount double"
)


def row(i, members=1, money=10.25, plan="p", memberships=1):
    return ("2024-01", str(i), "l", "c", plan, memberships, members, money, 0.0, 0.0)


SAME = [row(i, members=i % 5, money=i / 3) for i in range(400)]


def sides(spark, left, right):
    return [spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (left, right)]


def plainly(left, right, null_safe=False):
    """All rows through the full join."""
    joined = full_reconcile(left, right, MEMBERSHIP_KEYS, list(MEMBERSHIP_MEASURES), null_safe)
    bad = F.col("production_active_memberships").isNull() | F.col("existing_active_memberships").isNull()
    for name, decimals in MEMBERSHIP_MEASURES.items():
        a, b = (F.coalesce(f"{tag}_{name}", F.lit(0)) for tag in ("production", "existing"))
        bad |= a != b if decimals is None else F.round(a, decimals) != F.round(b, decimals)
    return joined.where(bad)


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


CASES = {
    "equal": ([], []),
    "missing and changed": ([row(1000), row(1001, 2)], [row(1001, 3), row(1002)]),
    "null keys on both sides": ([row(1000, plan=None)], [row(1000, plan=None)]),
    "null measures on both sides": ([row(1000, memberships=None)], [row(1000, memberships=None)]),
    "null against zero": ([row(1000, members=None)], [row(1000, members=0)]),
    "below half a cent": ([row(1000, money=1.001)], [row(1000, money=1.002)]),
    "the same two rows of one key": ([row(1000, 1), row(1000, 2)], [row(1000, 2), row(1000, 1)]),
    "a row twice on both sides": ([row(1000)] * 2, [row(1000)] * 2),
    "a row twice on one side": ([row(1000)] * 2, [row(1000)]),
    "not a number": ([row(1000, money=float("nan"))], [row(1000, money=float("nan"))]),
}


@pytest.mark.parametrize("bits", [(10, 20), (1, 2)])
@pytest.mark.parametrize("case", sorted(CASES))
def test_mismatches_are_those_of_the_full_join(spark, monkeypatch, case, bits):
    monkeypatch.setattr(reconcile, "COARSE_BITS", bits[0])
    monkeypatch.setattr(reconcile, "FINE_BITS", bits[1])
    left, right = sides(spark, *[SAME + more for more in CASES[case]])
    assert rows_of(reconcile_mismatches(left, right)) == rows_of(plainly(left, right))


def test_null_safe_mismatches(spark):
    left, right = sides(spark, SAME + [row(1, plan=None), row(2, 5, plan=None)], SAME + [row(1, plan=None)])
    got = reconcile_mismatches(left, right, null_safe=True)
    assert rows_of(got) == rows_of(plainly(left, right, null_safe=True)) and got.count() == 1


def test_summary_counts_every_row(spark):
    left, right = sides(spark, SAME + [row(1000, 7, 5.0), row(1001)], SAME + [row(1000, 9, 6.5), row(1002), row(1, plan=None)])
    got = reconcile_summary(left, right).first()
    assert got.reconciled_key_rows == 404
    assert (got.missing_from_production, got.missing_from_existing) == (2, 1)
    assert got.production_active_members == sum(r[6] for r in SAME) + 8
    assert got.existing_active_members == sum(r[6] for r in SAME) + 11
    assert got.production_total_mrr == pytest.approx(round(sum(r[7] for r in SAME) + 15.25, 2))
    assert got.abs_total_mrr_diff == pytest.approx(1.5 + 3 * 10.25)


def test_rows_of_equal_buckets_are_not_joined(spark):
    left, right = sides(spark, SAME + [row(1000)], SAME + [row(1000, 2)])
    values = {name: F.col(name) for name in MEMBERSHIP_MEASURES}
    sent_left, sent_right, equal = split_by_digest(left, right, MEMBERSHIP_KEYS, values, F.lit(False))
    assert (sent_left.count(), sent_right.count()) == (1, 1)
    assert rows_of(equal) == rows_of(spark.createDataFrame(SAME, SCHEMA))


def test_empty_sides(spark):
    left, right = sides(spark, [], [])
    assert reconcile_mismatches(left, right).count() == 0
    assert reconcile_summary(left, right).first().reconciled_key_rows == 0
    left, right = sides(spark, SAME, [])
    assert reconcile_mismatches(left, right).count() == len(SAME)


def test_keys_of_other_types_meet(spark):
    left, right = sides(spark, SAME, SAME)
    left = left.withColumn("company_id", F.col("company_id").cast("int"))
    assert reconcile_mismatches(left, right).count() == 0
    assert reconcile_summary(left, right).first().reconciled_key_rows == len(SAME)
