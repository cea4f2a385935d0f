"""Reconcile two tables of the same grain.

Two published tables mostly agree, so mismatches and the summary first compare digests: rows fall into buckets by
their key, and a bucket's digest does not depend on the order of its rows. Coarse buckets come first, so a task hands on a few
numbers per bucket; those that differ are cut into fine ones, and only rows of fine buckets that differ go into the full join.
Both sides are read several times, so hand in tables or stored rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360.functions.exprs import exact_sum, money_gap, money_value

LEFT, RIGHT = "production", "existing"

MEMBERSHIP_KEYS = ("month_start", "company_id", "location_id", "membership_category", "plan_id")
# Measure -> decimals compared; None compares as it is.
MEMBERSHIP_MEASURES: dict[str, int | None] = {
    "active_memberships": None,
    "active_members": None,
    "total_mrr": 2,
    "total_calculated_list_price": 2,
    "total_calculated_discount_amount": 2,
}


def membership_side(status: DataFrame) -> DataFrame:
    """The membership mart in the shape of the table it is compared with."""
    return status.withColumnRenamed("officernd_company_id", "company_id").select(
        *MEMBERSHIP_KEYS, *MEMBERSHIP_MEASURES
    )


def full_reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """Full outer join on the keys, each measure under a prefix per side.

    A NULL key part matches nothing, so such a row shows up as missing on each side;
    ``null_safe=True`` lets NULLs meet.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(
            *[F.col(k).alias(f"_{tag}_{k}") for k in keys],
            *[F.col(m).alias(f"{tag}_{m}") for m in measures],
        )

    def same(key: str) -> Column:
        a, b = F.col(f"_{LEFT}_{key}"), F.col(f"_{RIGHT}_{key}")
        return a.eqNullSafe(b) if null_safe else a == b

    condition = reduce(lambda a, b: a & b, [same(key) for key in keys])
    joined = side(left, LEFT).join(side(right, RIGHT), condition, "full")
    return joined.select(
        *[F.coalesce(f"_{LEFT}_{k}", f"_{RIGHT}_{k}").alias(k) for k in keys],
        *[F.col(f"{tag}_{m}") for m in measures for tag in (LEFT, RIGHT)],
    )


COARSE_BITS, FINE_BITS = 10, 20  # buckets per level as powers of two, so that a list of them may be sent to all


def _same_types(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """The right side with the named columns as the left side has them, so that equal values have equal hashes."""
    return right.withColumns({name: F.col(name).cast(left.schema[name].dataType) for name in names})


def _unequal(left: DataFrame, right: DataFrame, bucket: Column) -> DataFrame:
    """The buckets whose digests differ, and those that hold a row which has to be looked at anyway."""

    def digests(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(bucket.alias("_bucket")).agg(
            F.struct(
                F.count(F.lit(1)).alias("n"),
                F.bit_xor("_hash").alias("mixed"),
                F.sum(F.col("_other").bitwiseAND(F.lit(0xFFFFFFFF))).alias("added"),
            ).alias(tag),
            F.bool_or("_look").alias(f"{tag}_look"),
        )

    both = digests(left, LEFT).join(digests(right, RIGHT), "_bucket", "full")
    looked = F.coalesce(f"{LEFT}_look", F.lit(False)) | F.coalesce(f"{RIGHT}_look", F.lit(False))
    return both.where(~F.col(LEFT).eqNullSafe(F.col(RIGHT)) | looked).select("_bucket")


def split_by_digest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, Column],
    look: Column,
    null_safe: bool = False,
    unique: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of both sides that have to be joined, and the left rows that surely have one equal partner.

    values: what has to agree, by the names of its columns on both sides. look: rows that are
    joined whatever their digests. Rows with a NULL key meet nothing, so they always go on, unless ``null_safe``.
    Where a key occurs twice a join pairs its rows anew, which no digest shows, so such buckets go on too; ``unique`` says
    that there are none on the left and spares the search, which moves eight bytes a row.
    """
    null_key = F.lit(False)
    if not null_safe:
        null_key = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])

    def prepared(df: DataFrame) -> DataFrame:
        agreed = [value for value in values.values()]
        return df.withColumns(
            {
                "_null_key": null_key,
                "_key": F.xxhash64(*keys),
                "_hash": F.xxhash64(*keys, *agreed),
                "_other": F.xxhash64(F.lit(1), *keys, *agreed),
                "_look": F.coalesce(look, F.lit(False)),
            }
        )

    sides = {LEFT: prepared(left), RIGHT: prepared(_same_types(left, right, [*keys, *values]))}
    keyed = {tag: df.where(~F.col("_null_key")) for tag, df in sides.items()}

    def bucket(bits: int) -> Column:
        return F.shiftrightunsigned("_key", 64 - bits)

    coarse = _unequal(*keyed.values(), bucket(COARSE_BITS))

    def among(df: DataFrame, bits: int, buckets: DataFrame, how: str) -> DataFrame:
        small = F.broadcast(buckets)  # at most 2**bits numbers
        return df.withColumn("_bucket", bucket(bits)).join(small, "_bucket", how).drop("_bucket")

    fine = _unequal(*[among(df, COARSE_BITS, coarse, "left_semi") for df in keyed.values()], bucket(FINE_BITS))
    if not unique:
        twice = keyed[LEFT].groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        fine = fine.union(twice.select(bucket(FINE_BITS).alias("_bucket"))).distinct()
    own = ["_null_key", "_key", "_hash", "_other", "_look"]
    sent = [
        among(keyed[tag], FINE_BITS, fine, "left_semi").union(sides[tag].where("_null_key")).drop(*own)
        for tag in (LEFT, RIGHT)
    ]
    return *sent, among(keyed[LEFT], FINE_BITS, fine, "left_anti").drop(*own)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def reconcile_mismatches(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = MEMBERSHIP_KEYS,
    measures: Mapping[str, int | None] = MEMBERSHIP_MEASURES,
    null_safe: bool = False,
    tolerance: float | None = None,
) -> DataFrame:
    """Rows missing on one side or differing in a measure.

    Measures with decimals are rounded and compared for equality; with ``tolerance``
    they may differ by up to that much, which does not flip at half a cent. Rows whose bucket has
    the same digest on both sides are not joined.
    """

    def differs(name: str, decimals: int | None) -> Column:
        a, b = _zero(f"{LEFT}_{name}"), _zero(f"{RIGHT}_{name}")
        if decimals is None:
            return a != b
        if tolerance is not None:
            return F.abs(a - b) > tolerance
        return F.round(a, decimals) != F.round(b, decimals)

    first = next(iter(measures))
    bad = [F.col(f"{tag}_{first}").isNull() for tag in (LEFT, RIGHT)]
    bad += [differs(name, decimals) for name, decimals in measures.items()]
    agreed = {
        name: _zero(name) if decimals is None or tolerance is not None else F.round(_zero(name), decimals)
        for name, decimals in measures.items()
    }
    left, right, _ = split_by_digest(left, right, keys, agreed, F.col(first).isNull(), null_safe)
    return full_reconcile(left, right, keys, list(measures), null_safe).where(
        reduce(lambda a, b: a | b, bad)
    )


def reconcile_summary(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = MEMBERSHIP_KEYS,
    null_safe: bool = False,
) -> DataFrame:
    """One row: keys compared, keys missing on each side, totals, absolute revenue gap.

    Rows with an equal partner, as their bucket's digests say, count for both sides without a join.
    """
    measures = ["active_memberships", "active_members", "total_mrr"]
    agreed = {name: F.col(name) for name in measures}
    left, right, equal = split_by_digest(left, right, keys, agreed, F.col(measures[0]).isNull(), null_safe)
    paired = [F.col(name).alias(f"{tag}_{name}") for name in measures for tag in (LEFT, RIGHT)]
    rows = full_reconcile(left, right, keys, measures, null_safe).drop(*keys).union(equal.select(*paired))

    def money(value: Column) -> Column:
        return money_value(exact_sum(value), 2)

    revenue = {tag: _zero(f"{tag}_total_mrr").cast("double") for tag in (LEFT, RIGHT)}
    return rows.agg(
        F.count(F.lit(1)).alias("reconciled_key_rows"),
        *[
            F.count_if(F.col(f"{tag}_active_memberships").isNull()).alias(f"missing_from_{tag}")
            for tag in (LEFT, RIGHT)
        ],
        *[
            F.sum(_zero(f"{tag}_{name}")).alias(f"{tag}_{name}")
            for name in ("active_memberships", "active_members")
            for tag in (LEFT, RIGHT)
        ],
        *[money(revenue[tag]).alias(f"{tag}_total_mrr") for tag in (LEFT, RIGHT)],
        money(money_gap(revenue[LEFT], revenue[RIGHT])).alias("abs_total_mrr_diff"),
    )


class NotReconciled(Exception):
    """Two tables that should agree do not."""


def require_reconciled(mismatches: DataFrame, examples: int = 5) -> None:
    """Fail the build if there is a mismatch; the message shows a few of them.

    Only the examples are read, so the first rows that differ end the search.
    """
    found = mismatches.limit(examples).collect()
    if found:
        shown = "; ".join(str(row.asDict()) for row in found)
        raise NotReconciled(f"at least {len(found)} rows do not agree: {shown}")
