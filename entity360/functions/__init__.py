from entity360.functions.collect import distinct_sorted, ordered_ids, ranked_structs
from entity360.functions.exprs import (
    any_flag,
    blank_to_null,
    default_category,
    exact_sum,
    full_name,
    hashed_key,
    key_text,
    lowest_of,
    membership_label,
    membership_state,
    merge_money,
    money_gap,
    money_limbs,
    money_value,
    normalise_status,
    review_flag,
    surrogate_key,
    times_money,
)

__all__ = [
    "any_flag",
    "blank_to_null",
    "default_category",
    "distinct_sorted",
    "exact_sum",
    "full_name",
    "hashed_key",
    "key_text",
    "lowest_of",
    "membership_label",
    "membership_state",
    "merge_money",
    "money_gap",
    "money_limbs",
    "money_value",
    "normalise_status",
    "ordered_ids",
    "ranked_structs",
    "review_flag",
    "surrogate_key",
    "times_money",
]
