"""Array-building aggregates. Each collects only what the result itself holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_ids(value: Column, when: Column | None = None) -> Column:
    """Ascending array of all non-NULL values, duplicates kept."""
    kept = value if when is None else F.when(when, value)
    return F.sort_array(F.collect_list(kept))


def distinct_sorted(value: Column) -> Column:
    """Ascending array of all distinct non-NULL values.

    For a limited array use ``smallest_distinct``, which drops the surplus before
    anything is collected.
    """
    return F.sort_array(F.collect_set(value))


def ranked_structs(
    rank: Column, limit: int, fields: Sequence[str], when: Column | None = None
) -> Column:
    """Array of structs ordered by ``rank``, keeping ranks up to ``limit``.

    The caller must already have dropped the rows beyond its largest limit, so
    that no more than that is buffered per group.
    """
    kept = rank <= limit if when is None else (rank <= limit) & when
    packed = F.when(kept, F.struct(rank.alias("rank"), F.struct(*fields).alias("item")))
    return F.transform(F.sort_array(F.collect_list(packed)), lambda entry: entry["item"])
