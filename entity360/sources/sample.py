"""The fourteen sources, derived from the generic test tables.

NULLs and odd values come from modulus rules, so another SQL engine can state the same
rules. Tables are read with a given schema: no footer is opened to plan a query.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entity360.sources.loader import conform_source

AS_OF = date(1999, 6, 15)

TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


class SampleSources:
    """Sources by name over the Parquet files in ``folder``; each is built once."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder
        self._sources: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = conform_source(_RULES[name](self), name)
        return self._sources[name]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self._spark.read.schema(TABLES[name])
            self._tables[name] = reader.parquet(f"{self._folder}/{name}.parquet")
        return self._tables[name]


# --- Identity -------------------------------------------------------------------------


def _mapping_part(system: str, key: str, entity: str, name: str, rules: dict[str, str]) -> list[str]:
    return [
        f"CASE WHEN NOT ({rules['unmapped']}) THEN concat('ent-', CAST({entity} AS STRING)) END "
        "AS canonical_company_id",
        f"'{system}' AS source_system",
        f"CAST({key} AS STRING) AS source_company_id",
        f"{name} AS source_company_name",
        f"{rules['review']} AS requires_manual_review",
        f"{rules['confidence']} AS match_confidence",
        f"{key} % 3 + 1 AS match_priority",
        f"element_at(array('direct_id', 'name', 'domain'), CAST({key} % 3 AS INT) + 1) AS match_method",
        f"concat('key ', CAST({key} AS STRING)) AS match_detail",
        "TIMESTAMP_NTZ '1999-06-01 00:00:00' AS _resolved_at",
    ]


def _sometimes_null(key: str) -> dict[str, str]:
    return {
        "review": f"CASE WHEN {key} % 17 != 0 THEN {key} % 11 = 0 END",
        "confidence": f"CASE WHEN {key} % 13 != 0 THEN {key} % 100 / 100D END",
    }


def _users(s: SampleSources) -> DataFrame:
    return s.table("events").select("user_id").distinct()


def _mapping(s: SampleSources) -> DataFrame:
    crm = s.table("customer").selectExpr(
        *_mapping_part(
            "hubspot",
            "c_custkey",
            "c_custkey div 3",
            "c_name",
            {"unmapped": "c_custkey % 53 = 0", **_sometimes_null("c_custkey")},
        )
    )
    workspace = s.table("supplier").selectExpr(
        *_mapping_part(
            "officernd",
            "s_suppkey",
            "s_suppkey div 2",
            "s_name",
            {"unmapped": "s_suppkey % 7 = 3", **_sometimes_null("s_suppkey")},
        )
    )
    services = _users(s).selectExpr(
        *_mapping_part(
            "bigtime",
            "user_id",
            "user_id",
            "concat('Client ', CAST(user_id AS STRING))",
            {
                "unmapped": "user_id % 29 = 0",
                "review": "user_id % 11 = 0",
                "confidence": "user_id % 100 / 100D",
            },
        )
    )
    return crm.unionByName(workspace).unionByName(services)


# --- Company records ------------------------------------------------------------------


def _crm_companies(s: SampleSources) -> DataFrame:
    dates = (
        s.table("orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))
    )
    return (
        s.table("customer")
        .join(s.table("nation"), F.expr("c_nationkey = n_nationkey"))
        .join(dates, F.expr("o_custkey = c_custkey"), "left")
        .selectExpr(
            "c_custkey AS company_id",
            "CASE WHEN c_custkey % 19 = 0 OR c_custkey div 3 % 17 = 5 THEN '' ELSE c_name END AS company_name",
            "CASE WHEN c_custkey % 10 = 0 THEN '' "
            "ELSE concat('c', CAST(c_custkey AS STRING), '.example') END AS company_domain",
            "c_mktsegment AS industry",
            "CASE WHEN c_custkey % 4 = 1 THEN '' "
            "ELSE concat('City ', CAST(c_custkey % 40 AS STRING)) END AS property_city",
            "n_name AS property_country",
            "CAST(c_custkey % 500 AS DOUBLE) AS employee_count",
            "c_acctbal AS annual_revenue",
            "first_order AS created_at",
            "CASE WHEN c_custkey % 23 != 0 THEN last_order END AS updated_at",
        )
    )


def _raw_companies(s: SampleSources) -> DataFrame:
    return s.table("customer").selectExpr(
        "c_custkey AS id",
        "CASE WHEN c_custkey % 31 != 0 THEN CAST(c_nationkey AS BIGINT) END AS property_hubspot_owner_id",
        "c_name AS property_name",
    )


def _owners(s: SampleSources) -> DataFrame:
    return s.table("nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS owner_id",
        "CASE WHEN n_nationkey % 6 != 0 THEN n_name END AS first_name",
        "CASE WHEN n_nationkey % 4 != 0 THEN concat('Owner', CAST(n_nationkey AS STRING)) END AS last_name",
        "CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE concat(lower(n_name), '@owner.example') END AS email",
    )


def _workspace_companies(s: SampleSources) -> DataFrame:
    dates = (
        s.table("lineitem")
        .groupBy("l_suppkey")
        .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    )
    return (
        s.table("supplier")
        .join(dates, F.expr("l_suppkey = s_suppkey"), "left")
        .selectExpr(
            "CAST(s_suppkey AS STRING) AS company_id",
            "CASE WHEN s_suppkey % 8 != 5 THEN s_name END AS company_name",
            "concat('s', CAST(s_suppkey AS STRING), '@space.example') AS company_email",
            "CASE WHEN s_suppkey % 4 = 0 THEN '' "
            "ELSE concat('space.example/', CAST(s_suppkey AS STRING)) END AS company_url",
            "CASE s_suppkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' END AS company_status",
            "CASE WHEN s_suppkey % 2 = 0 THEN 'startup' ELSE 'partner' END AS company_type",
            "concat('tier ', CAST(s_suppkey % 4 AS STRING)) AS company_tier",
            "concat('loc-', CAST(s_suppkey % 5 AS STRING)) AS location_id",
            "CAST(first_ship AS DATE) AS start_date",
            "last_ship AS modified_at",
        )
    )


def _services_clients(s: SampleSources) -> DataFrame:
    return _users(s).selectExpr(
        "user_id AS client_id",
        "CASE WHEN user_id % 7 = 0 THEN '' ELSE concat('Client ', CAST(user_id AS STRING)) END AS client_name",
        "concat('Client ', CAST(user_id AS STRING), ' Ltd') AS client_legal_name",
        "concat('C-', CAST(user_id AS STRING)) AS client_code",
        "CASE WHEN user_id % 3 = 0 THEN '' ELSE 'external' END AS client_type",
        "concat('City ', CAST(user_id % 40 AS STRING)) AS city",
        "concat('State ', CAST(user_id % 50 AS STRING)) AS state",
        "'NATION_1' AS country",
        "CASE WHEN user_id % 8 != 1 THEN user_id % 5 = 0 END AS is_deleted",
    )


# --- Engagements ----------------------------------------------------------------------


def _deals(s: SampleSources) -> DataFrame:
    return s.table("orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS deal_id",
        "concat('Deal ', CAST(o_orderkey AS STRING)) AS deal_name",
        "o_orderpriority AS deal_type",
        "CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'won' "
        "WHEN o_orderstatus = 'O' THEN 'open' WHEN o_orderkey % 2 = 0 THEN 'lost' ELSE 'other' END AS deal_status",
        "CASE WHEN o_orderkey % 5 != 0 THEN o_orderdate END AS work_start_date",
        "CASE WHEN o_orderkey % 10 != 0 THEN o_orderdate + INTERVAL 10 DAYS END AS close_date",
        "o_orderdate - INTERVAL 5 DAYS AS created_at",
        "CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 100 DAYS END AS work_end_date",
        "CASE WHEN o_orderkey % 43 != 0 THEN o_totalprice END AS deal_amount",
    )


def _deal_links(s: SampleSources) -> DataFrame:
    """Per order its primary company, and by rule two other associations."""
    return s.table("orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS deal_id",
        """inline(array_compact(array(
             named_struct('company_id', CAST(o_custkey AS STRING), 'category', 'HUBSPOT_DEFINED', 'type_id', 5L),
             CASE WHEN o_orderkey % 4 = 0 THEN
               named_struct('company_id', CAST(o_custkey + 1 AS STRING), 'category', 'HUBSPOT_DEFINED', 'type_id', 6L) END,
             CASE WHEN o_orderkey % 6 = 0 THEN
               named_struct('company_id', CAST(o_custkey + 2 AS STRING), 'category', 'USER_DEFINED', 'type_id', 5L) END
           )))""",
    )


def _projects(s: SampleSources) -> DataFrame:
    return s.table("orders").selectExpr(
        "o_orderkey AS id",
        "concat('Project ', CAST(o_orderkey AS STRING)) AS property_project_name",
        "o_orderpriority AS property_project_category",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in progress' END "
        "AS property_project_status",
        "o_orderdate AS property_project_start_date",
        "CASE WHEN o_orderstatus != 'O' THEN o_orderdate + INTERVAL 90 DAYS END "
        "AS property_project_end_date",
        "CASE WHEN o_orderkey % 4 != 0 THEN concat('Studio ', CAST(o_orderkey % 4 AS STRING)) END "
        "AS property_offering",
        "CASE WHEN o_orderkey % 41 = 0 THEN TRUE WHEN o_orderkey % 2 = 0 THEN FALSE END "
        "AS _fivetran_deleted",
    )


def _project_links(s: SampleSources) -> DataFrame:
    """Startups from the order's customer, now and then two; partners from its lines.

    Partners on line number 7 have no company row.
    """
    startups = s.table("orders").selectExpr(
        "o_orderkey AS from_id",
        "explode(array_compact(array(o_custkey, CASE WHEN o_orderkey % 50 = 0 THEN o_custkey + 1 END))) AS to_id",
        "105L AS type_id",
    )
    partners = s.table("lineitem").selectExpr(
        "l_orderkey AS from_id",
        "CASE WHEN l_linenumber = 7 THEN l_suppkey + 1000000000 ELSE l_suppkey END AS to_id",
        "107L AS type_id",
    )
    return startups.unionByName(partners)


def _services_projects(s: SampleSources) -> DataFrame:
    return s.table("events").selectExpr(
        "event_id AS project_id",
        "user_id AS client_id",
        "concat('Services ', CAST(event_id AS STRING)) AS project_name",
        "CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS production_status_name",
        "CASE WHEN event_id % 9 != 0 THEN event_id % 2 = 0 END AS is_inactive",
        "CAST(ts AS DATE) AS start_date",
        "CASE WHEN event_id % 4 != 0 THEN date_add(CAST(ts AS DATE), 30) END AS end_date",
        "value AS budget_fees",
    )


# --- Memberships ----------------------------------------------------------------------

_MEMBERSHIP_ID = (
    "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), "
    "CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING))"
)
_LIST_PRICE = "CASE WHEN l_partkey % 4 != 0 THEN l_extendedprice END"
_NET_PRICE = "CASE WHEN l_partkey % 8 != 0 THEN l_extendedprice * (1D - l_discount) END"
_PLAIN_PRICE = "CASE WHEN l_partkey % 16 != 0 THEN l_extendedprice END"
# Every tenth company left at the end of a year.
_CONTRACTED = "l_discount > 0.01D AND NOT (l_suppkey % 10 = 4 AND l_shipdate >= '1999-01-01')"
_GRANTED = "CASE WHEN l_partkey % 6 != 0 THEN l_extendedprice * l_discount END"

_MEMBERSHIP = (
    f"{_MEMBERSHIP_ID} AS membership_id",
    "CAST(l_suppkey AS STRING) AS company_id",
    "CAST(l_orderkey AS STRING) AS member_id",
    "CASE l_linenumber % 7 WHEN 0 THEN 'active' WHEN 1 THEN 'expired' WHEN 2 THEN 'not_started' "
    "WHEN 3 THEN 'not_approved' WHEN 4 THEN 'on_hold' WHEN 6 THEN 'paused' END AS membership_status",
    f"{_LIST_PRICE} AS calculated_list_price",
    f"{_NET_PRICE} AS discounted_price",
    f"{_PLAIN_PRICE} AS price",
)


def _membership_detail(s: SampleSources) -> DataFrame:
    return s.table("lineitem").selectExpr(
        *_MEMBERSHIP,
        "CASE WHEN l_partkey % 3 != 0 THEN concat('asg-', CAST(l_partkey AS STRING)) END AS assignment_id",
        "CAST(l_shipdate AS DATE) AS period_start_date",
        "CASE WHEN l_linestatus != 'O' THEN date_add(CAST(l_shipdate AS DATE), 365) END AS period_end_date",
        "concat('Membership ', CAST(l_orderkey AS STRING)) AS membership_name",
        "nullif(l_returnflag, 'N') AS membership_category",
    )


def _membership_months(s: SampleSources) -> DataFrame:
    return s.table("lineitem").selectExpr(
        *_MEMBERSHIP,
        "trunc(CAST(l_shipdate AS DATE), 'month') AS month_start",
        "CASE WHEN l_partkey % 50 != 0 THEN l_returnflag END AS location_id",
        "concat('Location ', l_returnflag) AS location_name",
        "lower(l_returnflag) AS location_code",
        "nullif(l_linestatus, 'O') AS membership_category",
        "CAST(l_partkey % 10 AS STRING) AS plan_id",
        "concat('Plan ', CAST(l_partkey % 10 AS STRING)) AS plan_name",
        f"{_GRANTED} AS calculated_discount_amount",
        f"{_CONTRACTED} AS is_contracted_in_month",
    )


def _existing_mart(s: SampleSources) -> DataFrame:
    """The monthly aggregate worked out by another route, with seeded differences.

    Company 7 lacks its months of March; company 11 has two members too many; company 13
    has its revenue off by one; company 17 goes by another id.
    """
    lines = s.table("lineitem").where(_CONTRACTED).selectExpr(
        "trunc(CAST(l_shipdate AS DATE), 'month') AS month_start",
        "CAST(l_suppkey AS STRING) AS company_id",
        "CASE WHEN l_partkey % 50 != 0 THEN l_returnflag END AS location_id",
        "CASE WHEN l_linestatus = 'O' THEN 'Uncategorized' ELSE l_linestatus END AS membership_category",
        "CAST(l_partkey % 10 AS STRING) AS plan_id",
        f"{_MEMBERSHIP_ID} AS membership",
        "l_orderkey AS member",
        f"coalesce({_NET_PRICE}, {_PLAIN_PRICE}, 0D) AS revenue",
        f"coalesce({_LIST_PRICE}, {_NET_PRICE}, {_PLAIN_PRICE}, 0D) AS listed",
        f"coalesce({_GRANTED}, 0D) AS granted",
    )

    grain = ["company_id", "month_start", "location_id", "membership_category", "plan_id"]
    # Dealt out once by the grain; the greatest ranks within it are the distinct counts.
    within = Window.partitionBy(*grain)
    ranked = lines.repartition(*grain)
    for name in ("membership", "member"):
        ranked = ranked.withColumn(f"{name}s", F.dense_rank().over(within.orderBy(name)))

    def total(name: str, alias: str) -> Column:
        return F.sum(F.col(name).cast("decimal(28,9)")).cast("double").alias(alias)

    return (
        ranked.groupBy(*grain)
        .agg(
            F.max("memberships").cast("bigint").alias("active_memberships"),
            F.max("members").cast("bigint").alias("active_members"),
            total("revenue", "total_mrr"),
            total("listed", "total_calculated_list_price"),
            total("granted", "total_calculated_discount_amount"),
        )
        .where("NOT (company_id = '7' AND month(month_start) = 3)")
        .selectExpr(
            "month_start",
            "CASE WHEN company_id = '17' THEN '999999999' ELSE company_id END AS company_id",
            "location_id",
            "membership_category",
            "plan_id",
            "active_memberships",
            "active_members + CASE WHEN company_id = '11' THEN 2 ELSE 0 END AS active_members",
            "total_mrr + CASE WHEN company_id = '13' THEN 1 ELSE 0 END AS total_mrr",
            "total_calculated_list_price",
            "total_calculated_discount_amount",
        )
    )


_RULES: dict[str, Callable[[SampleSources], DataFrame]] = {
    "int_cross_source_companies": _mapping,
    "stg_hubspot_companies": _crm_companies,
    "hubspot.company": _raw_companies,
    "hubspot.owner": _owners,
    "stg_officernd_companies": _workspace_companies,
    "stg_bigtime_clients": _services_clients,
    "stg_hubspot_deals": _deals,
    "stg_hubspot_deal_company": _deal_links,
    "hubspot.projects": _projects,
    "hubspot.projects_to_company": _project_links,
    "int_membership_detail": _membership_detail,
    "stg_bigtime_projects": _services_projects,
    "int_membership_months": _membership_months,
    "mart_membership_detail": _existing_mart,
}
