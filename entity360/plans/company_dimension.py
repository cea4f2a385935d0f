"""One row per canonical company: its ids in every system and display attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360 import constants as C
from entity360.functions.collect import ordered_ids
from entity360.functions.exprs import blank_to_null, full_name
from entity360.operators.relational import first_per_key
from entity360.sources.schemas import DIM_COMPANY_SCHEMA

ID_ARRAYS = {
    "hubspot_company_ids": C.HUBSPOT,
    "officernd_company_ids": C.OFFICERND,
    "bigtime_client_ids": C.BIGTIME,
}


def mapped(bridge: DataFrame) -> DataFrame:
    return bridge.where(F.col("canonical_company_id").isNotNull())


def id_rollup(bridge: DataFrame, systems: Mapping[str, str] = ID_ARRAYS) -> DataFrame:
    """Ids per system, coverage and mapping quality per canonical company.

    ``systems`` maps each output array to its source system. A NULL review flag counts
    as 'no review' here, unlike in the facts.
    """
    ids, system = F.col("source_company_id"), F.col("source_system")
    return (
        mapped(bridge)
        .groupBy("canonical_company_id")
        .agg(
            *[ordered_ids(ids, system == name).alias(array) for array, name in systems.items()],
            # A handful of systems, so a set per company beats a second shuffle.
            F.size(F.collect_set(system)).cast("bigint").alias("source_system_count"),
            F.bool_or(F.coalesce(F.col("requires_manual_review"), F.lit(False))).alias(
                "has_manual_review_mapping"
            ),
            F.min("match_confidence").alias("min_match_confidence"),
        )
    )


def representative(
    bridge: DataFrame,
    records: DataFrame,
    system: str,
    id_col: str,
    order_by: Sequence[Column],
    attributes: Mapping[str, Column],
) -> DataFrame:
    """The best source record of each canonical company, by ``order_by``."""
    links = (
        mapped(bridge)
        .where(F.col("source_system") == system)
        .select("canonical_company_id", F.col("source_company_id").alias("_id"))
    )
    candidates = links.join(records, F.col("_id") == records[id_col].cast("string"), "inner")
    best = first_per_key(candidates, ["canonical_company_id"], order_by)
    return best.select(
        "canonical_company_id", *[value.alias(name) for name, value in attributes.items()]
    )


def with_owner(crm: DataFrame, raw_company: DataFrame, owner: DataFrame) -> DataFrame:
    """CRM companies with the owner the raw company table names.

    Owners go to the narrow raw table first. The wide CRM table is then shuffled once, on
    the id text, which is also the key of its join with the bridge.
    """
    people = owner.select(
        F.col("owner_id"),
        full_name(F.col("first_name"), F.col("last_name")).alias("primary_owner_name"),
        blank_to_null(F.col("email")).alias("primary_owner_email"),
    )
    owned = raw_company.join(
        people, F.col("owner_id") == F.col("property_hubspot_owner_id"), "left"
    ).select(
        F.col("id").cast("string").alias("_raw_id"),
        F.col("property_hubspot_owner_id").cast("string").alias("primary_owner_id"),
        "primary_owner_name",
        "primary_owner_email",
    )
    return crm.join(owned, F.col("_raw_id") == F.col("company_id").cast("string"), "left").drop(
        "_raw_id"
    )


def _blank_last(name: str) -> Column:
    return blank_to_null(F.col(name)).isNull().asc()


def representative_crm(
    bridge: DataFrame, crm: DataFrame, raw_company: DataFrame, owner: DataFrame
) -> DataFrame:
    """Named companies first, then the latest update, then the id as text.

    Owner e-mail, name and id settle ties between copies of one company.
    """
    return representative(
        bridge,
        with_owner(crm, raw_company, owner),
        C.HUBSPOT,
        "company_id",
        [
            _blank_last("company_name"),
            F.col("updated_at").desc_nulls_last(),
            F.col("company_id").cast("string").asc_nulls_first(),
            F.col("primary_owner_email").asc_nulls_last(),
            F.col("primary_owner_name").asc_nulls_last(),
            F.col("primary_owner_id").asc_nulls_last(),
        ],
        {
            "source_company_id": F.col("company_id").cast("string"),
            "company_name": blank_to_null(F.col("company_name")),
            "company_domain": blank_to_null(F.col("company_domain")),
            "hubspot_industry": blank_to_null(F.col("industry")),
            "hubspot_city": blank_to_null(F.col("property_city")),
            "hubspot_country": blank_to_null(F.col("property_country")),
            "employee_count": F.col("employee_count"),
            "annual_revenue": F.col("annual_revenue"),
            "created_at": F.col("created_at"),
            "updated_at": F.col("updated_at"),
            "primary_owner_id": F.col("primary_owner_id"),
            "primary_owner_name": F.col("primary_owner_name"),
            "primary_owner_email": F.col("primary_owner_email"),
        },
    )


def representative_workspace(bridge: DataFrame, workspace: DataFrame) -> DataFrame:
    """Active companies first, then the latest change, then lower-case name, then id.

    Among ties a NULL name comes before any other.
    """
    return representative(
        bridge,
        workspace,
        C.OFFICERND,
        "company_id",
        [
            F.when(F.col("company_status") == C.ACTIVE, 0).otherwise(1).asc(),
            F.col("modified_at").desc_nulls_last(),
            F.lower("company_name").asc_nulls_first(),
            F.col("company_id").asc_nulls_first(),
        ],
        {
            "source_company_id": F.col("company_id"),
            "company_name": blank_to_null(F.col("company_name")),
            "officernd_company_email": blank_to_null(F.col("company_email")),
            "officernd_company_url": blank_to_null(F.col("company_url")),
            "officernd_company_status": blank_to_null(F.col("company_status")),
            "officernd_company_type": blank_to_null(F.col("company_type")),
            "officernd_company_tier": blank_to_null(F.col("company_tier")),
            "officernd_location_id": F.col("location_id"),
            "start_date": F.col("start_date"),
            "modified_at": F.col("modified_at"),
        },
    )


def representative_client(bridge: DataFrame, clients: DataFrame) -> DataFrame:
    """Live clients first (NULL means live), then named ones, then lower-case name, then id."""
    return representative(
        bridge,
        clients,
        C.BIGTIME,
        "client_id",
        [
            F.coalesce(F.col("is_deleted"), F.lit(False)).asc(),
            _blank_last("client_name"),
            F.lower("client_name").asc_nulls_first(),
            F.col("client_id").cast("string").asc_nulls_first(),
        ],
        {
            "source_company_id": F.col("client_id").cast("string"),
            "client_name": blank_to_null(F.col("client_name")),
            "bigtime_client_legal_name": blank_to_null(F.col("client_legal_name")),
            "bigtime_client_code": blank_to_null(F.col("client_code")),
            "bigtime_client_type": blank_to_null(F.col("client_type")),
            "bigtime_city": blank_to_null(F.col("city")),
            "bigtime_state": blank_to_null(F.col("state")),
            "bigtime_country": blank_to_null(F.col("country")),
            "is_deleted": F.col("is_deleted"),
        },
    )


def dim_company(
    bridge: DataFrame,
    crm: DataFrame,
    raw_company: DataFrame,
    owner: DataFrame,
    workspace: DataFrame,
    clients: DataFrame,
) -> DataFrame:
    """Id roll-up with the three representatives; all four inputs are keyed by canonical id."""
    named = {
        C.HUBSPOT: (representative_crm(bridge, crm, raw_company, owner), "company_name"),
        C.OFFICERND: (representative_workspace(bridge, workspace), "company_name"),
        C.BIGTIME: (representative_client(bridge, clients).drop("is_deleted"), "client_name"),
    }
    joined = id_rollup(bridge)
    for system, (best, name) in named.items():
        best = best.drop("source_company_id").withColumnRenamed(name, f"_{system}_name")
        joined = joined.join(best, "canonical_company_id", "left")
    names = {system: F.col(f"_{system}_name") for system in named}
    winner = F.coalesce(
        *[F.when(value.isNotNull(), F.lit(system)) for system, value in names.items()]
    )
    return joined.withColumns(
        {"company_name": F.coalesce(*names.values()), "company_name_source": winner}
    ).select(*DIM_COMPANY_SCHEMA.fieldNames())
