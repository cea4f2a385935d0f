from entity360.operators.bridge import bridge_lookup, bridge_source
from entity360.operators.relational import (
    align_events,
    associated,
    first_per_key,
    in_period,
    not_deleted,
    smallest_distinct,
    with_defaults,
)

__all__ = [
    "align_events",
    "associated",
    "bridge_lookup",
    "bridge_source",
    "first_per_key",
    "in_period",
    "not_deleted",
    "smallest_distinct",
    "with_defaults",
]
