"""All five models from the sources, in dependency order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame

from entity360.operators.bridge import bridge_source
from entity360.operators.publish import (
    TABLE,
    VIEW,
    Buckets,
    Replaced,
    keep_statistics,
    publish,
    publish_view,
    replace_partitions,
    resolve_materialization,
)
from entity360.operators.quality import WriteChecks, expectation_report, require_passed
from entity360.plans.company_dimension import dim_company
from entity360.plans.company_mart import company_mart
from entity360.plans.descriptions import COLUMN_COMMENTS, MODEL_COMMENTS
from entity360.plans.engagement_ledger import engagement_ledger
from entity360.plans.membership import membership_status
from entity360.sources.schemas import BRIDGE_SCHEMA

Tables = Mapping[str, DataFrame]

LAYERS = {
    "bridge_company_source": "data",
    "dim_company": "dimension",
    "fct_engagement_ledger": "fact",
    "mart_membership_status": "mart",
    "company_mart": "user_mart",
}


# Tables with few rows per value of these columns may be laid out in buckets of them. The ledger and the
# status are not among them: a company may hold a large share of their rows, and would be one bucket.
BUCKET_COLUMNS = {
    "bridge_company_source": ("source_system", "source_company_id"),
    "dim_company": ("canonical_company_id",),
    "company_mart": ("canonical_company_id",),
}

# The columns of each model that others join and filter it by.
STATISTICS_COLUMNS = {
    "bridge_company_source": ("source_system", "source_company_id", "canonical_company_id"),
    "dim_company": ("canonical_company_id",),
    "fct_engagement_ledger": ("canonical_company_id", "source_system", "engagement_type"),
    "mart_membership_status": ("month_start", "canonical_company_id", "officernd_company_id"),
    "company_mart": ("canonical_company_id",),
}


class Published(dict[str, DataFrame]):
    """The models by name, as readers see them, and what publishing found.

    ``row_checks``: (model, expectation, column, failing rows) of the models written as tables, counted
    during the write. ``row_counts``: rows written per model. ``replaced``: of models that were replaced partition by partition.
    """

    def __init__(self) -> None:
        super().__init__()
        self.row_checks: list[tuple[str, str, str, int]] = []
        self.row_counts: dict[str, int] = {}
        self.replaced: dict[str, Replaced] = {}

    def all_checks(self) -> list[tuple[str, str, str, int]]:
        """All expectations; only what could not be counted while writing reads the models again."""
        rest = expectation_report(self, checked=self.row_counts)
        return self.row_checks + ([tuple(r) for r in rest.collect()] if rest else [])


def bridge_view_sql(table: str) -> str:
    """The bridge as a query over the catalog table that holds the mapping."""
    return f"SELECT {', '.join(BRIDGE_SCHEMA.fieldNames())} FROM {table}"


def build_bridge(sources: Tables) -> DataFrame:
    return bridge_source(sources["int_cross_source_companies"])


def build_dim(sources: Tables, bridge: DataFrame) -> DataFrame:
    return dim_company(
        bridge,
        sources["stg_hubspot_companies"],
        sources["hubspot.company"],
        sources["hubspot.owner"],
        sources["stg_officernd_companies"],
        sources["stg_bigtime_clients"],
    )


def build_ledger(
    sources: Tables,
    bridge: DataFrame,
    as_of: date,
    newest: int | None = None,
    small_workspace: bool = False,
    short_keys: bool = False,
) -> DataFrame:
    return engagement_ledger(
        sources["stg_hubspot_deals"],
        sources["stg_hubspot_deal_company"],
        sources["hubspot.projects"],
        sources["hubspot.projects_to_company"],
        sources["hubspot.company"],
        sources["int_membership_detail"],
        sources["stg_bigtime_projects"],
        bridge,
        as_of,
        newest,
        small_workspace,
        short_keys,
    )


def build_status(
    sources: Tables, bridge: DataFrame, as_of: date, period: str = "past_current"
) -> DataFrame:
    return membership_status(sources["int_membership_months"], bridge, as_of, period)


def require_utc(sources: Tables) -> None:
    """Days are taken from timestamps in the session's zone, so that has to be UTC."""
    spark = sources["int_membership_months"].sparkSession
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"the session's time zone must be UTC, not {zone}: call tune(spark)")


def build_models(sources: Tables, as_of: date) -> dict[str, DataFrame]:
    """The models as unexecuted plans; reading the last one works out all of them."""
    require_utc(sources)
    bridge = build_bridge(sources)
    dim = build_dim(sources, bridge)
    ledger = build_ledger(sources, bridge, as_of)
    status = build_status(sources, bridge, as_of)
    return {
        "bridge_company_source": bridge,
        "dim_company": dim,
        "fct_engagement_ledger": ledger,
        "mart_membership_status": status,
        "company_mart": company_mart(dim, status, ledger, as_of),
    }


def publish_models(
    sources: Tables,
    as_of: date,
    settings: Mapping[str, str],
    *,
    namespace: str | None = None,
    bridge_table: str | None = None,
    buckets: int | None = None,
    refresh: bool = False,
    strict: bool = False,
    statistics: bool = False,
) -> Published:
    """Publish in dependency order; each model reads its inputs as published.

    ``settings`` maps layers to 'view' or 'table'. At scale make the data layer tables:
    the ledger and the status are read twice by the company mart. The row-wise expectations of a table
    are counted as it is written.

    ``bridge_table`` names the catalog table behind the mapping: a bridge published as a view is then one
    of the catalog, in ``namespace``. ``buckets`` lays the tables in BUCKET_COLUMNS out in so many buckets, so
    that joins don't move them. ``refresh`` replaces only the months of the membership status that differ,
    where its table exists. ``strict`` stops before the next model is built if a row-wise expectation fails.
    ``statistics`` keeps those of STATISTICS_COLUMNS of each table, before the next model is built.
    """
    require_utc(sources)
    if bridge_table and not namespace:
        raise ValueError("a view of the catalog needs a namespace")
    spark = sources["int_membership_months"].sparkSession
    published = Published()

    def put(name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        kind = resolve_materialization(settings, LAYERS[name])
        described = {"comment": MODEL_COMMENTS[name], "column_comments": COLUMN_COMMENTS[name]}
        if kind == VIEW:
            if bridge_table and name == "bridge_company_source":
                query = bridge_view_sql(bridge_table)
                published[name] = publish_view(spark, name, query, namespace=namespace, **described)
            else:
                published[name] = publish(df, name, kind, **described)
            return published[name]
        checks = WriteChecks(name)
        full = f"{namespace}.{name}" if namespace else name
        if refresh and partition_by and spark.catalog.tableExists(full):
            published.replaced[name] = replace_partitions(
                df, name, partition_by[0], namespace=namespace, watch=checks.watch
            )
            published[name] = spark.table(full)
        else:
            layout = Buckets(buckets, BUCKET_COLUMNS[name]) if buckets and name in BUCKET_COLUMNS else None
            published[name] = publish(
                df,
                name,
                kind,
                namespace=namespace,
                partition_by=partition_by,
                buckets=layout,
                watch=checks.watch,
                **described,
            )
        if statistics:
            keep_statistics(spark, name, STATISTICS_COLUMNS[name], namespace=namespace)
            published[name] = spark.table(full)
        published.row_counts[name] = checks.row_count
        published.row_checks += checks.rows()
        if strict:
            require_passed(checks.rows())
        return published[name]

    bridge = put("bridge_company_source", build_bridge(sources))
    dim = put("dim_company", build_dim(sources, bridge))
    ledger = put("fct_engagement_ledger", build_ledger(sources, bridge, as_of))
    status = put(
        "mart_membership_status",
        build_status(sources, bridge, as_of),
        partition_by=["month_start"],
    )
    put("company_mart", company_mart(dim, status, ledger, as_of))
    return published
