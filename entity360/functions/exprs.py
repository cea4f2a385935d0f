"""Scalar rules as Column expressions; all of them stay in whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from entity360 import constants as C

# Characters with the Unicode White_Space property.
WHITESPACE = (
    "\x09\x0a\x0b\x0c\x0d\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def key_text(*parts: Column) -> Column:
    """The parts joined by a vertical bar; a NULL part counts as an empty text."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.concat_ws(C.KEY_SEPARATOR, *texts)


def hashed_key(text: Column) -> Column:
    """Lower-case SHA-256 hex, which no compression makes shorter: take it after rows have been moved."""
    return F.sha2(text, 256)


def surrogate_key(*parts: Column) -> Column:
    """Lower-case SHA-256 hex of the parts joined by a vertical bar.

    A NULL part counts as an empty text, so the key is never NULL. The bar is not
    escaped: parts that contain one can collide, which ``expect_unique`` reports.
    """
    return hashed_key(key_text(*parts))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """Both names with one space between; NULL when nothing but white space is left."""
    joined = F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))
    return blank_to_null(F.trim(joined, F.lit(WHITESPACE)))


def normalise_status(raw: Column, known: Sequence[str], otherwise: str = C.UNKNOWN) -> Column:
    """Keep a known status (case-sensitive); everything else, NULL included, becomes ``otherwise``."""
    return F.when(raw.isin(*known), raw).otherwise(F.lit(otherwise))


def membership_state(raw: Column, start: Column, end: Column, as_of: date) -> Column:
    """Known status, else a state told from the dates, else the raw text or 'unknown'."""
    today = F.lit(as_of)
    return (
        F.when(raw.isin(*C.MEMBERSHIP_STATUSES), raw)
        .when(end < today, F.lit(C.EXPIRED))
        .when(start > today, F.lit(C.NOT_STARTED))
        .otherwise(F.coalesce(raw, F.lit(C.UNKNOWN)))
    )


def membership_label(current_memberships: Column, has_history: Column) -> Column:
    return (
        F.when(F.coalesce(current_memberships, F.lit(0)) > 0, F.lit(C.ACTIVE_MEMBER))
        .when(has_history, F.lit(C.FORMER_MEMBER))
        .otherwise(F.lit(C.NO_MEMBERSHIP))
    )


def default_category(category: Column) -> Column:
    return F.coalesce(category, F.lit(C.UNCATEGORIZED))


def review_flag(flag: Column) -> Column:
    """Facts treat a missing flag as 'needs review'."""
    return F.coalesce(flag, F.lit(True))


def lowest_of(*values: Column) -> Column:
    """Smallest non-NULL value; NULL when all are NULL."""
    return F.least(*values)


def any_flag(*flags: Column) -> Column:
    """TRUE when a flag is TRUE; NULL flags count as FALSE."""
    return reduce(lambda a, b: a | b, [F.coalesce(flag, F.lit(False)) for flag in flags])


def _holds(amount: Column) -> Column:
    """Whether the money type holds an amount; NULL for NULL."""
    size = F.abs(amount)
    return (size < C.MONEY_RANGE) & ((size >= C.MONEY_LEAST) | (amount == 0))


# A total is a sum of longs in three units, so rows are added up without any decimal, and merged the same way.
_UNITS = ("giga", "whole", "nano")  # 10**9, 1 and 10**-9
_GIGA = 10**9


def money_limbs(amount: Column) -> Column:
    """An amount as a struct of longs in the three units, or as ``rest`` where it doesn't fit; NULL for NULL.

    The longs are its shortest decimal text, rounded half up to nine decimals.

    1. Below 2**22 that text is within a quarter of a unit of the binary value, so rounding the value gives the same
       unless it lies near the middle between two units.
    2. An amount of up to four decimals and fifteen digits is found by dividing them again.
    3. Only the rest takes the way over a decimal.

    Put it into a column of its own where several sums follow, so that it is worked out once a row.
    """
    double = amount.cast("double")
    size = F.abs(double)
    sign = F.when(double < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    floor = F.floor(size)
    scaled = (size - floor) * float(_GIGA)
    nano = F.rint(scaled)
    near = (size < float(1 << 22)) & (F.abs(scaled - nano) < 0.25)
    cents = F.rint(size * 1e4)
    short = (cents < 1e15) & (cents / 1e4 == size)
    digits = cents.try_cast("bigint")
    decimal = size.try_cast(C.MONEY)
    whole = F.floor(decimal)
    giga = F.lit(_GIGA).cast("decimal(10,0)")

    def limbs(*parts: Column) -> Column:
        named = zip(_UNITS, parts, strict=True)
        longs = [(sign * part.try_cast("bigint")).alias(unit) for unit, part in named]
        return F.struct(*longs, F.lit(None).cast("double").alias("rest"))

    nothing = [F.lit(None).cast("bigint").alias(unit) for unit in _UNITS]
    return (
        F.when(~_holds(double), F.struct(*nothing, double.alias("rest")))
        .when(near, limbs(F.lit(0), floor, nano))
        .when(short, limbs(F.lit(0), F.floor(cents / 1e4), (digits % 10_000) * 100_000))
        .when(size.isNotNull(), limbs(F.floor(whole / giga), whole % giga, (decimal - whole) * giga))
    )


def _money(limbs: list[Column], rest: Column) -> Column:
    named = zip(_UNITS, limbs, strict=True)
    return F.struct(*[limb.alias(unit) for unit, limb in named], rest.alias("rest"))


def exact_sum(amount: Column) -> Column:
    """A total in parts: sums of longs, so it does not depend on how rows were split over tasks, and beside
    them the sum of the amounts that don't fit, NULL if there are none. No amount is lost.

    A group may have some 9 * 10**9 rows; beyond, Spark reports the overflow of a sum and gives no wrong one.
    """
    return merge_money(money_limbs(amount))


def merge_money(total: Column) -> Column:
    """Amounts from ``money_limbs``, or totals of ``exact_sum``, added up."""
    return _money([F.sum(total[unit]) for unit in _UNITS], F.sum(total["rest"]))


def _exact_part(total: Column) -> Column:
    """The sums of longs as one decimal; NULL when there was no amount, or when a decimal can't hold it."""
    wide = "decimal(36,9)"
    giga = (total["giga"].cast("decimal(19,0)") * F.lit(_GIGA).cast("decimal(10,0)")).try_cast(wide)
    nano = total["nano"].cast("decimal(19,0)") / F.lit(_GIGA).cast("decimal(10,0)")
    return (giga + total["whole"].cast(wide) + nano.cast(wide)).try_cast("decimal(38,9)")


def times_money(total: Column, n: Column) -> Column:
    """A total ``n`` times over."""
    products = [F.try_multiply(total[unit], n.cast("bigint")) for unit in _UNITS]
    fits = reduce(lambda a, b: a & b, [product.isNotNull() for product in products])
    lost = total["whole"].isNotNull() & ~fits
    whole = F.when(lost, _exact_part(total).cast("double") * n)
    rest = F.when(
        total["rest"].isNotNull() | lost, F.coalesce(total["rest"] * n, F.lit(0.0)) + F.coalesce(whole, F.lit(0.0))
    )
    return _money([F.when(fits, product) for product in products], rest)


def money_value(total: Column, decimals: int | None = None) -> Column:
    """A total as double, rounded while it is still exact; NULL when there was no amount."""

    def rounded(value: Column) -> Column:
        return value if decimals is None else F.round(value, decimals)

    exact = _exact_part(total)
    whole = F.coalesce(exact.cast("double"), F.lit(0.0)) + total["rest"]
    return F.when(total["rest"].isNotNull(), rounded(whole)).otherwise(rounded(exact).cast("double"))


def money_gap(a: Column, b: Column) -> Column:
    """The absolute difference of two amounts, exact where both are held exactly."""
    exact = F.abs(a.try_cast(C.MONEY) - b.try_cast(C.MONEY)).cast("double")
    return F.when(_holds(a) & _holds(b), exact).otherwise(F.abs(a - b))
