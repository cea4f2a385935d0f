"""One row per engagement event, from four sources, with stable event ids."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entity360 import constants as C
from entity360.functions.collect import distinct_sorted
from entity360.functions.exprs import (
    blank_to_null,
    default_category,
    hashed_key,
    key_text,
    membership_state,
    normalise_status,
)
from entity360.operators.bridge import bridge_lookup
from entity360.operators.relational import RESOLVED, align_events, associated, not_deleted
from entity360.sources.schemas import LEDGER_SCHEMA


def _event_key_text() -> Column:
    """The text that an aligned event's key hashes, put together from what the row holds anyway."""
    kind, source_id = F.col("engagement_type"), F.col("source_engagement_id")
    by_company = (
        F.when(kind == C.DEAL, F.lit(C.DEAL_KEY))
        .when(F.col("source_system") == C.HUBSPOT, F.lit(C.STARTUP_PROJECT_KEY))
        .otherwise(F.lit(C.SERVICES_PROJECT_KEY))
    )
    period = (F.col("engagement_event_id"), F.col("start_date"), F.col("end_date"))
    return F.when(
        kind == C.MEMBERSHIP, key_text(F.lit(C.MEMBERSHIP_KEY), source_id, *period)
    ).otherwise(key_text(by_company, source_id, F.col("source_company_id")))


def _published(resolved: DataFrame, short_keys: bool = False) -> DataFrame:
    """Resolved events with their key, which is 64 characters that no compression makes shorter.

    So it is worked out after the bridge join; in place of it, events come with the part of it that no
    other column holds: a membership's assignment. A short key is the same hash as 32 bytes, which sort
    like the characters.
    """
    key = hashed_key(_event_key_text())
    hashed = resolved.withColumn("engagement_event_id", F.unhex(key) if short_keys else key)
    return hashed.select(*LEDGER_SCHEMA.fieldNames())


def _resolve(events: DataFrame, bridge: DataFrame, short_keys: bool = False) -> DataFrame:
    """Look up the canonical company of aligned events, whatever their system."""
    found = bridge_lookup(events, bridge, events["source_system"], "source_company_id")
    return _published(found, short_keys)


def _resolved_links(links: DataFrame, company_col: str, bridge: DataFrame) -> DataFrame:
    """CRM links with the canonical company of the linked one.

    Links are narrow; looked up before they meet the wide rows of deals or projects, they spare those
    the shuffle to the bridge.
    """
    keyed = links.withColumn("_company", F.col(company_col).cast("string"))
    return bridge_lookup(keyed, bridge, C.HUBSPOT, "_company").drop("_company")


def _newest(events: DataFrame, limit: int) -> DataFrame:
    """Each source company's newest events of a branch, by the order that ``engagement_lists`` goes by.

    A source company has one canonical company, so the newest events of that one are among these. A branch
    has one type. The limit works ahead of the shuffle, too.
    """
    newest = Window.partitionBy("source_company_id").orderBy(
        F.col("start_date").desc_nulls_last(), F.col("_key")
    )
    ranked = events.withColumn("_key", hashed_key(_event_key_text())).withColumn(
        "_rank", F.row_number().over(newest)
    )
    return ranked.where(F.col("_rank") <= limit).drop("_key", "_rank")


def _resolved_columns(pairs: DataFrame) -> list[str]:
    """What the bridge has said of the links already, if they were looked up."""
    return [name for name in RESOLVED if name in pairs.columns]


def _deal_rows(deals: DataFrame, assoc: DataFrame) -> DataFrame:
    pairs = associated(
        deals, assoc, "deal_id", "deal_id", C.PRIMARY_COMPANY_TYPE, C.PRIMARY_COMPANY_CATEGORY
    )
    raw = F.col("deal_status")
    return align_events(
        pairs.select(
            F.col("company_id").alias("source_company_id"),
            F.col("deal_id").alias("source_engagement_id"),
            F.col("deal_name").alias("engagement_name"),
            F.col("deal_type").alias("engagement_subtype"),
            normalise_status(raw, C.DEAL_STATUSES).alias("engagement_status"),
            raw.alias("engagement_status_raw"),
            F.to_date(F.coalesce("work_start_date", "close_date", "created_at")).alias("start_date"),
            F.to_date("work_end_date").alias("end_date"),
            F.col("deal_amount").alias("amount"),
            *_resolved_columns(pairs),
        ),
        source_system=C.HUBSPOT,
        engagement_category=C.BUSINESS,
        engagement_type=C.DEAL,
    )


def project_partners(assoc: DataFrame, company: DataFrame) -> DataFrame:
    """Distinct partner ids and names per project, before any join with projects.

    The arrays drop repeated links themselves. Links are moved as they are: arrays of one or two
    partners, gathered before the shuffle, take more.
    """
    partners = assoc.where(F.col("type_id") == C.PROJECT_PARTNER_TYPE).select("from_id", "to_id")
    names = company.select(F.col("id"), F.col("property_name"))
    return (
        partners.join(names, F.col("id") == F.col("to_id"), "left")
        .repartition("from_id")
        .groupBy(F.col("from_id").alias("project_id"))
        .agg(
            distinct_sorted(F.col("to_id").cast("string")).alias("partner_company_ids"),
            distinct_sorted(F.col("property_name")).alias("partner_names"),
        )
    )


def _startup_project_rows(
    projects: DataFrame, assoc: DataFrame, company: DataFrame, startups: DataFrame | None = None
) -> DataFrame:
    """``startups`` are the associations with the startups' companies looked up, if they were."""
    live = not_deleted(projects, "_fivetran_deleted")
    links = assoc if startups is None else startups
    pairs = associated(live, links, "id", "from_id", C.PROJECT_STARTUP_TYPE)
    partners = project_partners(assoc, company)
    joined = pairs.join(partners, F.col("project_id") == F.col("id"), "left")
    raw = F.col("property_project_status")
    return align_events(
        joined.select(
            F.col("to_id").alias("source_company_id"),
            F.col("id").alias("source_engagement_id"),
            F.col("property_project_name").alias("engagement_name"),
            F.col("property_project_category").alias("engagement_subtype"),
            F.coalesce(raw, F.lit(C.UNKNOWN)).alias("engagement_status"),
            raw.alias("engagement_status_raw"),
            F.to_date("property_project_start_date").alias("start_date"),
            F.to_date("property_project_end_date").alias("end_date"),
            F.col("property_offering").alias("program_name"),
            F.coalesce("partner_company_ids", F.array().cast("array<string>")).alias(
                "partner_company_ids"
            ),
            F.coalesce("partner_names", F.array().cast("array<string>")).alias("partner_names"),
            *_resolved_columns(pairs),
        ),
        source_system=C.HUBSPOT,
        engagement_category=C.BUSINESS,
        engagement_type=C.PROJECT,
    )


def _membership_rows(detail: DataFrame, as_of: date) -> DataFrame:
    raw, start, end = (
        F.col("membership_status"),
        F.col("period_start_date"),
        F.col("period_end_date"),
    )
    return align_events(
        detail.select(
            F.col("assignment_id").alias("engagement_event_id"),
            F.col("company_id").alias("source_company_id"),
            F.col("membership_id").alias("source_engagement_id"),
            F.col("membership_name").alias("engagement_name"),
            default_category(F.col("membership_category")).alias("engagement_subtype"),
            membership_state(raw, start, end, as_of).alias("engagement_status"),
            raw.alias("engagement_status_raw"),
            start.alias("start_date"),
            end.alias("end_date"),
            F.coalesce("calculated_list_price", "discounted_price", "price").alias("amount"),
            F.col("member_id"),
            F.col("membership_id"),
        ),
        source_system=C.OFFICERND,
        engagement_category=C.BUSINESS,
        engagement_type=C.MEMBERSHIP,
    )


def _services_project_rows(projects: DataFrame) -> DataFrame:
    inactive = F.col("is_inactive")
    return align_events(
        projects.select(
            F.col("client_id").alias("source_company_id"),
            F.col("project_id").alias("source_engagement_id"),
            F.col("project_name").alias("engagement_name"),
            blank_to_null(F.col("production_status_name")).alias("engagement_subtype"),
            F.when(inactive, C.INACTIVE).otherwise(C.ACTIVE).alias("engagement_status"),
            inactive.alias("engagement_status_raw"),
            F.col("start_date"),
            F.col("end_date"),
            F.col("budget_fees").alias("amount"),
        ),
        source_system=C.BIGTIME,
        engagement_category=C.BUSINESS,
        engagement_type=C.PROJECT,
    )


def deal_events(deals: DataFrame, assoc: DataFrame, bridge: DataFrame) -> DataFrame:
    """Deals with their primary companies; a deal with two of them gives two events."""
    return _resolve(_deal_rows(deals, assoc), bridge)


def startup_project_events(
    projects: DataFrame, assoc: DataFrame, company: DataFrame, bridge: DataFrame
) -> DataFrame:
    """Live startup projects, one event per startup, with partner arrays."""
    return _resolve(_startup_project_rows(projects, assoc, company), bridge)


def membership_events(detail: DataFrame, bridge: DataFrame, as_of: date) -> DataFrame:
    """Membership periods; unknown states are told from the dates at ``as_of``."""
    return _resolve(_membership_rows(detail, as_of), bridge)


def services_project_events(projects: DataFrame, bridge: DataFrame) -> DataFrame:
    """Projects of the services system."""
    return _resolve(_services_project_rows(projects), bridge)


def engagement_ledger(
    deals: DataFrame,
    deal_assoc: DataFrame,
    projects: DataFrame,
    project_assoc: DataFrame,
    company: DataFrame,
    detail: DataFrame,
    services_projects: DataFrame,
    bridge: DataFrame,
    as_of: date,
    newest: int | None = None,
    small_workspace: bool = False,
    short_keys: bool = False,
) -> DataFrame:
    """All four branches, resolved by one bridge join after the union.

    One join shuffles the bridge once instead of once per branch, and rows are keyed
    by source id, so unmapped events never pile up on a NULL canonical id.

    ``small_workspace`` says that the workspace part of the bridge fits into every task (see ``is_small``).
    Then memberships, which are most of the rows, find their company where they are and aren't shuffled,
    and the other branches have joins of their own: deals and projects by their links, ahead of the
    join with the wide rows.

    ``short_keys`` leaves event ids as bytes, for readers that only sort by them.

    ``newest`` serves lists of a company's newest events and needs no whole ledger: memberships and services
    projects, of which a company may have very many, are cut to that many per source company before
    they are shuffled to the bridge. All that a list of that length holds is still there.
    """
    members, services = _membership_rows(detail, as_of), _services_project_rows(services_projects)
    if newest is not None:
        services = _newest(services, newest)
    if small_workspace:
        startups = _resolved_links(project_assoc, "to_id", bridge)
        branches = [
            _deal_rows(deals, _resolved_links(deal_assoc, "company_id", bridge)),
            _startup_project_rows(projects, project_assoc, company, startups),
            bridge_lookup(members, F.broadcast(bridge), C.OFFICERND, "source_company_id"),
            bridge_lookup(services, bridge, C.BIGTIME, "source_company_id"),
        ]
        return _published(reduce(DataFrame.unionByName, branches), short_keys)
    if newest is not None:
        members = _newest(members, newest)
    branches = [
        _deal_rows(deals, deal_assoc),
        _startup_project_rows(projects, project_assoc, company),
        members,
        services,
    ]
    return _resolve(reduce(DataFrame.unionByName, branches), bridge, short_keys)
