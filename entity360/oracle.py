"""DuckDB SQL for every named query, stated apart from the Spark code.

Each entry is a final SELECT over named building blocks; ``_assemble`` puts the blocks
it needs in front. Sources follow the same modulus rules as ``sources.sample``.
"""

from __future__ import annotations

import re

AS_OF = "DATE '1999-06-15'"
MONTH = "DATE '1999-06-01'"


def _exact(value: str) -> str:
    """Decimal sum, published as the nearest double; what a decimal can't hold is added as double."""
    held = f"CAST(CAST(SUM(TRY_CAST(CAST({value} AS VARCHAR) AS DECIMAL(28,9))) FILTER (WHERE {_held(value)}) AS VARCHAR) AS DOUBLE)"
    rest = f"FILTER (WHERE NOT {_held(value)})"
    return f"CASE WHEN count(*) {rest} = 0 THEN {held} ELSE coalesce({held}, 0) + SUM(CAST({value} AS DOUBLE)) {rest} END"


def _held(value: str) -> str:
    size = f"abs(CAST({value} AS DOUBLE))"
    return f"({size} < 1e19 AND ({size} >= 1e-3 OR {size} = 0))"


def _dec(value: str) -> str:
    return f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(28,9))"


def _texts(value: str, limit: str = "") -> str:
    """Sorted distinct non-NULL values as one text."""
    picked = f"list_sort(list(DISTINCT {value}) FILTER (WHERE {value} IS NOT NULL))"
    if limit:
        picked = f"list_slice({picked}, 1, {limit})"
    return f"coalesce(array_to_string({picked}, ';'), '')"


def _mapping_part(key: str, system: str, ent: str, unmapped: str, nulls: bool, name: str, src: str) -> str:
    review = f"{key} % 11 = 0"
    sure = f"({key} % 100) / 100.0"
    if nulls:
        review = f"CASE WHEN {key} % 17 <> 0 THEN {review} END"
        sure = f"CASE WHEN {key} % 13 <> 0 THEN {sure} END"
    return f"""
  SELECT CASE WHEN NOT ({unmapped}) THEN 'ent-' || CAST(CAST({ent} AS BIGINT) AS VARCHAR) END AS canonical_company_id,
         '{system}' AS source_system, CAST({key} AS VARCHAR) AS source_company_id, {name} AS source_company_name,
         {review} AS requires_manual_review, CAST({sure} AS DOUBLE) AS match_confidence,
         {key} % 3 + 1 AS match_priority,
         CASE {key} % 3 WHEN 0 THEN 'direct_id' WHEN 1 THEN 'name' ELSE 'domain' END AS match_method,
         'key ' || CAST({key} AS VARCHAR) AS match_detail, TIMESTAMP '1999-06-01 00:00:00' AS _resolved_at
  FROM {src}"""


_LINE_ID = (
    "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || "
    "CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)"
)
_LINE_STATE = (
    "CASE l_linenumber % 7 WHEN 0 THEN 'active' WHEN 1 THEN 'expired' WHEN 2 THEN 'not_started' "
    "WHEN 3 THEN 'not_approved' WHEN 4 THEN 'on_hold' WHEN 6 THEN 'paused' END"
)
_LIST = "CASE WHEN l_partkey % 4 <> 0 THEN l_extendedprice END"
_NET = "CASE WHEN l_partkey % 8 <> 0 THEN l_extendedprice * (CAST(1 AS DOUBLE) - l_discount) END"
_PLAIN = "CASE WHEN l_partkey % 16 <> 0 THEN l_extendedprice END"
_GRANTED = "CASE WHEN l_partkey % 6 <> 0 THEN l_extendedprice * l_discount END"

# --- Building blocks: sources ---------------------------------------------------------

_BLOCKS: dict[str, str] = {
    "src_mapping": " UNION ALL ".join(
        [
            _mapping_part(
                "c_custkey", "hubspot", "floor(c_custkey / 3)", "c_custkey % 53 = 0", True, "c_name", "customer"
            ),
            _mapping_part(
                "s_suppkey", "officernd", "floor(s_suppkey / 2)", "s_suppkey % 7 = 3", True, "s_name", "supplier"
            ),
            _mapping_part(
                "user_id",
                "bigtime",
                "user_id",
                "user_id % 29 = 0",
                False,
                "'Client ' || CAST(user_id AS VARCHAR)",
                "(SELECT DISTINCT user_id FROM events)",
            ),
        ]
    ),
    "src_crm": """
  SELECT c_custkey AS company_id, CASE WHEN c_custkey % 19 = 0 OR CAST(floor(c_custkey / 3) AS BIGINT) % 17 = 5 THEN '' ELSE c_name END AS company_name,
         CASE WHEN c_custkey % 10 = 0 THEN '' ELSE 'c' || CAST(c_custkey AS VARCHAR) || '.example' END AS company_domain,
         c_mktsegment AS industry,
         CASE WHEN c_custkey % 4 = 1 THEN '' ELSE 'City ' || CAST(c_custkey % 40 AS VARCHAR) END AS property_city,
         n_name AS property_country, CAST(c_custkey % 500 AS DOUBLE) AS employee_count, c_acctbal AS annual_revenue,
         (SELECT min(o_orderdate) FROM orders WHERE o_custkey = c_custkey) AS created_at,
         CASE WHEN c_custkey % 23 <> 0 THEN (SELECT max(o_orderdate) FROM orders WHERE o_custkey = c_custkey) END AS updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "src_raw": """
  SELECT c_custkey AS id, CASE WHEN c_custkey % 31 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS owner_key, c_name AS property_name
  FROM customer""",
    "src_owner": """
  SELECT CAST(n_nationkey AS BIGINT) AS owner_id,
         nullif(trim(coalesce(CASE WHEN n_nationkey % 6 <> 0 THEN n_name END, '') || ' ' ||
                     coalesce(CASE WHEN n_nationkey % 4 <> 0 THEN 'Owner' || CAST(n_nationkey AS VARCHAR) END, '')), '') AS full_name,
         CASE WHEN n_nationkey % 5 <> 0 THEN lower(n_name) || '@owner.example' END AS email
  FROM nation""",
    "src_space": """
  SELECT CAST(s_suppkey AS VARCHAR) AS company_id, CASE WHEN s_suppkey % 8 <> 5 THEN s_name END AS company_name,
         's' || CAST(s_suppkey AS VARCHAR) || '@space.example' AS company_email,
         CASE WHEN s_suppkey % 4 <> 0 THEN 'space.example/' || CAST(s_suppkey AS VARCHAR) END AS company_url,
         CASE s_suppkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' END AS company_status,
         CASE s_suppkey % 2 WHEN 0 THEN 'startup' ELSE 'partner' END AS company_type,
         'tier ' || CAST(s_suppkey % 4 AS VARCHAR) AS company_tier, 'loc-' || CAST(s_suppkey % 5 AS VARCHAR) AS location_id,
         (SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem WHERE l_suppkey = s_suppkey) AS start_date,
         (SELECT max(l_shipdate) FROM lineitem WHERE l_suppkey = s_suppkey) AS modified_at
  FROM supplier""",
    "src_client": """
  SELECT user_id AS client_id, CASE WHEN user_id % 7 <> 0 THEN 'Client ' || CAST(user_id AS VARCHAR) END AS client_name,
         'Client ' || CAST(user_id AS VARCHAR) || ' Ltd' AS legal_name, 'C-' || CAST(user_id AS VARCHAR) AS code,
         CASE WHEN user_id % 3 <> 0 THEN 'external' END AS kind, 'City ' || CAST(user_id % 40 AS VARCHAR) AS city,
         'State ' || CAST(user_id % 50 AS VARCHAR) AS state, 'NATION_1' AS country,
         CASE WHEN user_id % 8 <> 1 THEN user_id % 5 = 0 END AS is_deleted
  FROM (SELECT DISTINCT user_id FROM events)""",
    "src_deal": """
  SELECT CAST(o_orderkey AS VARCHAR) AS deal_id, 'Deal ' || CAST(o_orderkey AS VARCHAR) AS deal_name, o_orderpriority AS deal_type,
         CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CASE o_orderstatus WHEN 'F' THEN 'won' WHEN 'O' THEN 'open' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'lost' ELSE 'other' END END END AS deal_status,
         CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate WHEN o_orderkey % 10 <> 0 THEN o_orderdate + INTERVAL 10 DAY
              ELSE o_orderdate - INTERVAL 5 DAY END AS DATE) AS started,
         CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) + 100 END AS ended,
         CASE WHEN o_orderkey % 43 <> 0 THEN o_totalprice END AS deal_amount
  FROM orders""",
    "src_deal_link": """
  SELECT CAST(o_orderkey AS VARCHAR) AS deal_id, CAST(o_custkey AS VARCHAR) AS company_id, 'HUBSPOT_DEFINED' AS category, CAST(5 AS BIGINT) AS type_id FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey + 1 AS VARCHAR), 'HUBSPOT_DEFINED', 6 FROM orders WHERE o_orderkey % 4 = 0
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey + 2 AS VARCHAR), 'USER_DEFINED', 5 FROM orders WHERE o_orderkey % 6 = 0""",
    "src_project": """
  SELECT o_orderkey AS id, o_custkey, 'Project ' || CAST(o_orderkey AS VARCHAR) AS name, o_orderpriority AS kind,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in progress' END AS state,
         CAST(o_orderdate AS DATE) AS started, CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 90 END AS ended,
         CASE WHEN o_orderkey % 4 <> 0 THEN 'Studio ' || CAST(o_orderkey % 4 AS VARCHAR) END AS offering,
         o_orderkey % 41 = 0 AS deleted
  FROM orders""",
    "src_startup": """
  SELECT id, o_custkey AS company FROM src_project UNION ALL SELECT id, o_custkey + 1 FROM src_project WHERE id % 50 = 0""",
    "src_partner": """
  SELECT id, CASE WHEN l_linenumber = 7 THEN l_suppkey + 1000000000 ELSE l_suppkey END AS partner
  FROM src_project JOIN lineitem ON l_orderkey = id""",
    "src_detail": f"""
  SELECT {_LINE_ID} AS membership_id, CASE WHEN l_partkey % 3 <> 0 THEN 'asg-' || CAST(l_partkey AS VARCHAR) END AS assignment_id,
         CAST(l_shipdate AS DATE) AS started, CASE WHEN l_linestatus <> 'O' THEN CAST(l_shipdate AS DATE) + 365 END AS ended,
         CAST(l_suppkey AS VARCHAR) AS company_id, 'Membership ' || CAST(l_orderkey AS VARCHAR) AS name,
         coalesce(nullif(l_returnflag, 'N'), 'Uncategorized') AS category, {_LINE_STATE} AS state,
         coalesce({_LIST}, {_NET}, {_PLAIN}) AS amount, CAST(l_orderkey AS VARCHAR) AS member_id
  FROM lineitem""",
    "src_service": """
  SELECT event_id AS project_id, user_id AS client_id, 'Services ' || CAST(event_id AS VARCHAR) AS name,
         CASE WHEN event_id % 3 <> 0 THEN event_type END AS phase,
         CASE WHEN event_id % 9 <> 0 THEN event_id % 2 = 0 END AS inactive, CAST(ts AS DATE) AS started,
         CASE WHEN event_id % 4 <> 0 THEN CAST(ts AS DATE) + 30 END AS ended, value AS budget
  FROM events""",
    "src_month": f"""
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, CAST(l_suppkey AS VARCHAR) AS officernd_company_id,
         CASE WHEN l_partkey % 50 <> 0 THEN l_returnflag END AS location_id, 'Location ' || l_returnflag AS location_name, lower(l_returnflag) AS location_code,
         CASE WHEN l_linestatus = 'O' THEN 'Uncategorized' ELSE l_linestatus END AS membership_category,
         CAST(l_partkey % 10 AS VARCHAR) AS plan_id, 'Plan ' || CAST(l_partkey % 10 AS VARCHAR) AS plan_name,
         {_LINE_STATE} AS membership_status, CAST(l_orderkey AS VARCHAR) AS member_id, {_LINE_ID} AS membership_id,
         {_LIST} AS calculated_list_price, {_NET} AS discounted_price, {_PLAIN} AS price, {_GRANTED} AS calculated_discount_amount,
         l_discount > CAST(0.01 AS DOUBLE) AND NOT (l_suppkey % 10 = 4 AND l_shipdate >= TIMESTAMP '1999-01-01') AS contracted
  FROM lineitem""",
}

# --- Building blocks: models ----------------------------------------------------------

_STATUS_KEYS = (
    "month_start, canonical_company_id, officernd_company_id, location_id, location_name, location_code, "
    "membership_category, plan_id, plan_name"
)


def _status(rows: str) -> str:
    return f"""
  SELECT {_STATUS_KEYS}, canonical_company_id IS NULL AS canonical_company_id_is_null,
         count(DISTINCT membership_id) AS active_memberships, count(DISTINCT member_id) AS active_members,
         {_exact("coalesce(discounted_price, price, 0)")} AS total_mrr,
         {_exact("coalesce(calculated_list_price, discounted_price, price, 0)")} AS total_calculated_list_price,
         {_exact("coalesce(calculated_discount_amount, 0)")} AS total_calculated_discount_amount,
         bool_or(requires_manual_review) AS has_manual_review_mapping, min(match_confidence) AS min_match_confidence,
         {_texts("membership_status", "10")} AS observed_membership_statuses
  FROM {rows} GROUP BY ALL"""


def _month_rows(condition: str) -> str:
    return f"""
  SELECT m.* EXCLUDE (contracted), b.canonical_company_id, b.canonical_company_id IS NULL AS canonical_company_id_is_null,
         coalesce(b.requires_manual_review, TRUE) AS requires_manual_review, b.match_confidence
  FROM src_month m LEFT JOIN src_mapping b ON b.source_system = 'officernd' AND b.source_company_id = m.officernd_company_id
  WHERE m.contracted AND m.month_start {condition}"""


_EVENT_COLUMNS = (
    "engagement_event_id, source_company_id, source_system, engagement_type, source_engagement_id, engagement_name, "
    "engagement_subtype, engagement_status, engagement_status_raw, start_date, end_date, amount, member_id, "
    "membership_id, program_name, partner_company_ids, partner_names"
)


def _key(*parts: str) -> str:
    texts = [f"coalesce(CAST({part} AS VARCHAR), '')" for part in parts]
    return "sha256(" + " || '|' || ".join(texts) + ")"


def _mapped_events(events: str) -> str:
    return f"""
  SELECT e.engagement_event_id, b.canonical_company_id, b.canonical_company_id IS NULL AS canonical_company_id_is_null,
         'Business' AS engagement_category, e.* EXCLUDE (engagement_event_id),
         coalesce(b.requires_manual_review, TRUE) AS requires_manual_review, b.match_confidence
  FROM {events} e LEFT JOIN src_mapping b USING (source_system, source_company_id)"""


_ITEM = "engagement_name, engagement_status, start_date, end_date, source_system"
_PROJECT_ITEM = f"{_ITEM}, program_name, partner_company_ids, partner_names"


def _items(columns: str, limit: int, rank: str, where: str = "TRUE") -> str:
    """Ranked rows as one text, fields joined by '~', items by ';'."""
    parts = []
    for column in columns.split(", "):
        text = f"coalesce(CAST({column} AS VARCHAR), '')"
        if column.startswith("partner_"):
            text = f"replace({text}, ';', '+')"
        parts.append(text)
    row = " || '~' || ".join(parts)
    return f"coalesce(string_agg({row}, ';' ORDER BY {rank}) FILTER (WHERE {where} AND {rank} <= {limit}), '')"


def _typed_count(column: str, value: str) -> str:
    return f"count(*) FILTER (WHERE {column} = '{value}') AS {value}_engagement_count"


def _typed_amount(kind: str) -> str:
    amount = f"CASE WHEN engagement_type = '{kind}' THEN coalesce(amount, 0) ELSE 0 END"
    return f"{_exact(amount)} AS {kind}_amount"


_BLOCKS.update(
    {
        "rollup": """
  SELECT canonical_company_id,
         coalesce(string_agg(source_company_id, ';' ORDER BY source_company_id) FILTER (WHERE source_system = 'hubspot'), '') AS hubspot_company_ids,
         coalesce(string_agg(source_company_id, ';' ORDER BY source_company_id) FILTER (WHERE source_system = 'officernd'), '') AS officernd_company_ids,
         coalesce(string_agg(source_company_id, ';' ORDER BY source_company_id) FILTER (WHERE source_system = 'bigtime'), '') AS bigtime_client_ids,
         count(DISTINCT source_system) AS source_system_count,
         count(*) FILTER (WHERE requires_manual_review) > 0 AS has_manual_review_mapping, min(match_confidence) AS min_match_confidence
  FROM src_mapping WHERE canonical_company_id IS NOT NULL GROUP BY ALL""",
        "owned": """
  SELECT c.company_id, CAST(r.owner_key AS VARCHAR) AS primary_owner_id, o.full_name AS primary_owner_name, o.email AS primary_owner_email
  FROM src_crm c LEFT JOIN src_raw r ON r.id = c.company_id LEFT JOIN src_owner o ON o.owner_id = r.owner_key""",
        "best_crm": """
  SELECT b.canonical_company_id, b.source_company_id, nullif(c.company_name, '') AS company_name,
         nullif(c.company_domain, '') AS company_domain, c.industry AS hubspot_industry, nullif(c.property_city, '') AS hubspot_city,
         c.property_country AS hubspot_country, c.employee_count, c.annual_revenue, c.created_at, c.updated_at,
         w.primary_owner_id, w.primary_owner_name, w.primary_owner_email
  FROM src_mapping b JOIN src_crm c ON b.source_company_id = CAST(c.company_id AS VARCHAR) JOIN owned w USING (company_id)
  WHERE b.source_system = 'hubspot' AND b.canonical_company_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY b.canonical_company_id
            ORDER BY c.company_name = '', c.updated_at DESC NULLS LAST, b.source_company_id) = 1""",
        "best_space": """
  SELECT b.canonical_company_id, b.source_company_id, s.company_name, s.company_email AS officernd_company_email,
         s.company_url AS officernd_company_url, s.company_status AS officernd_company_status, s.company_type AS officernd_company_type,
         s.company_tier AS officernd_company_tier, s.location_id AS officernd_location_id, s.start_date, s.modified_at
  FROM src_mapping b JOIN src_space s ON b.source_company_id = s.company_id
  WHERE b.source_system = 'officernd' AND b.canonical_company_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY b.canonical_company_id
            ORDER BY s.company_status IS DISTINCT FROM 'active', s.modified_at DESC NULLS LAST,
                     lower(s.company_name) ASC NULLS FIRST, b.source_company_id) = 1""",
        "best_client": """
  SELECT b.canonical_company_id, b.source_company_id, c.client_name, c.legal_name AS bigtime_client_legal_name,
         c.code AS bigtime_client_code, c.kind AS bigtime_client_type, c.city AS bigtime_city, c.state AS bigtime_state,
         c.country AS bigtime_country, c.is_deleted
  FROM src_mapping b JOIN src_client c ON b.source_company_id = CAST(c.client_id AS VARCHAR)
  WHERE b.source_system = 'bigtime' AND b.canonical_company_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY b.canonical_company_id
            ORDER BY c.is_deleted IS NOT DISTINCT FROM TRUE, c.client_name IS NULL, lower(c.client_name), b.source_company_id) = 1""",
        "dim": """
  SELECT r.*, coalesce(h.company_name, o.company_name, t.client_name) AS company_name,
         CASE WHEN h.company_name IS NOT NULL THEN 'hubspot' WHEN o.company_name IS NOT NULL THEN 'officernd'
              WHEN t.client_name IS NOT NULL THEN 'bigtime' END AS company_name_source,
         h.* EXCLUDE (canonical_company_id, source_company_id, company_name, created_at, updated_at),
         o.* EXCLUDE (canonical_company_id, source_company_id, company_name, start_date, modified_at),
         t.* EXCLUDE (canonical_company_id, source_company_id, client_name, is_deleted)
  FROM rollup r LEFT JOIN best_crm h USING (canonical_company_id) LEFT JOIN best_space o USING (canonical_company_id)
       LEFT JOIN best_client t USING (canonical_company_id)""",
        "ev_deal": f"""
  SELECT {_key("'hubspot_deal'", "d.deal_id", "l.company_id")} AS engagement_event_id, l.company_id AS source_company_id,
         'hubspot' AS source_system, 'deal' AS engagement_type, d.deal_id AS source_engagement_id, d.deal_name AS engagement_name,
         d.deal_type AS engagement_subtype, CASE WHEN d.deal_status IN ('won', 'lost', 'open') THEN d.deal_status ELSE 'unknown' END AS engagement_status,
         d.deal_status AS engagement_status_raw, d.started AS start_date, d.ended AS end_date, d.deal_amount AS amount,
         CAST(NULL AS VARCHAR) AS member_id, CAST(NULL AS VARCHAR) AS membership_id, CAST(NULL AS VARCHAR) AS program_name,
         '' AS partner_company_ids, '' AS partner_names
  FROM src_deal d JOIN src_deal_link l USING (deal_id) WHERE l.category = 'HUBSPOT_DEFINED' AND l.type_id = 5""",
        "partners": f"""
  SELECT p.id AS project_id, {_texts("CAST(p.partner AS VARCHAR)")} AS partner_company_ids, {_texts("r.property_name")} AS partner_names
  FROM src_partner p LEFT JOIN src_raw r ON r.id = p.partner GROUP BY ALL""",
        "ev_project": f"""
  SELECT {_key("'hubspot_startup_project'", "p.id", "s.company")} AS engagement_event_id, CAST(s.company AS VARCHAR) AS source_company_id,
         'hubspot' AS source_system, 'project' AS engagement_type, CAST(p.id AS VARCHAR) AS source_engagement_id, p.name AS engagement_name,
         p.kind AS engagement_subtype, coalesce(p.state, 'unknown') AS engagement_status, p.state AS engagement_status_raw,
         p.started AS start_date, p.ended AS end_date, CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS member_id,
         CAST(NULL AS VARCHAR) AS membership_id, p.offering AS program_name, coalesce(x.partner_company_ids, '') AS partner_company_ids,
         coalesce(x.partner_names, '') AS partner_names
  FROM src_project p JOIN src_startup s USING (id) LEFT JOIN partners x ON x.project_id = p.id WHERE NOT p.deleted""",
        "ev_member": f"""
  SELECT {_key("'officernd_membership'", "membership_id", "assignment_id", "started", "ended")} AS engagement_event_id,
         company_id AS source_company_id, 'officernd' AS source_system, 'membership' AS engagement_type,
         membership_id AS source_engagement_id, name AS engagement_name, category AS engagement_subtype,
         CASE WHEN state IN ('active', 'expired', 'not_started', 'not_approved') THEN state WHEN ended < {AS_OF} THEN 'expired'
              WHEN started > {AS_OF} THEN 'not_started' ELSE coalesce(state, 'unknown') END AS engagement_status,
         state AS engagement_status_raw, started AS start_date, ended AS end_date, amount, member_id, membership_id,
         CAST(NULL AS VARCHAR) AS program_name, '' AS partner_company_ids, '' AS partner_names
  FROM src_detail""",
        "ev_service": f"""
  SELECT {_key("'bigtime_project'", "project_id", "client_id")} AS engagement_event_id, CAST(client_id AS VARCHAR) AS source_company_id,
         'bigtime' AS source_system, 'project' AS engagement_type, CAST(project_id AS VARCHAR) AS source_engagement_id, name AS engagement_name,
         phase AS engagement_subtype, CASE WHEN inactive THEN 'inactive' ELSE 'active' END AS engagement_status,
         CAST(inactive AS VARCHAR) AS engagement_status_raw, started AS start_date, ended AS end_date, budget AS amount,
         CAST(NULL AS VARCHAR) AS member_id, CAST(NULL AS VARCHAR) AS membership_id, CAST(NULL AS VARCHAR) AS program_name,
         '' AS partner_company_ids, '' AS partner_names
  FROM src_service""",
        "ev_all": " UNION ALL ".join(
            f"SELECT {_EVENT_COLUMNS} FROM {block}" for block in ("ev_deal", "ev_project", "ev_member", "ev_service")
        ),
        "ledger": _mapped_events("ev_all"),
        "month_rows": _month_rows(f"<= {MONTH}"),
        "month_rows_future": _month_rows(f"> {MONTH}"),
        "status": _status("month_rows"),
        "status_future": _status("month_rows_future"),
        "current": f"""
  SELECT canonical_company_id, TRUE AS has_active_membership, {_texts("location_id")} AS current_location_ids,
         {_texts("location_name")} AS current_location_names, {_texts("location_code")} AS current_location_codes,
         {_texts("membership_category")} AS current_membership_categories, {_texts("plan_id", "25")} AS current_plan_ids,
         {_texts("plan_name", "25")} AS current_plan_names, CAST(sum(active_memberships) AS BIGINT) AS current_active_memberships,
         CAST(sum(active_members) AS BIGINT) AS current_active_members, {_exact("total_mrr")} AS current_total_mrr,
         {_exact("total_calculated_list_price")} AS current_total_calculated_list_price,
         {_exact("total_calculated_discount_amount")} AS current_total_calculated_discount_amount,
         min(min_match_confidence) AS current_membership_min_match_confidence,
         bool_or(has_manual_review_mapping) AS has_current_membership_manual_review_mapping
  FROM status WHERE canonical_company_id IS NOT NULL AND month_start = {MONTH} GROUP BY ALL""",
        "history": f"""
  SELECT canonical_company_id, min(month_start) AS first_membership_month, max(month_start) AS most_recent_membership_month,
         count(DISTINCT month_start) AS membership_month_count, count(DISTINCT officernd_company_id) AS membership_officernd_company_count,
         count(DISTINCT location_id) AS membership_location_count, {_texts("membership_category")} AS all_membership_categories,
         CAST(sum(active_memberships) AS BIGINT) AS membership_month_active_membership_sum,
         CAST(sum(active_members) AS BIGINT) AS membership_month_active_member_sum, {_exact("total_mrr")} AS membership_month_total_mrr,
         bool_or(has_manual_review_mapping) AS has_membership_manual_review_mapping, min(min_match_confidence) AS membership_min_match_confidence
  FROM status WHERE canonical_company_id IS NOT NULL GROUP BY ALL""",
        "mapped_ledger": "SELECT * FROM ledger WHERE canonical_company_id IS NOT NULL",
        "counts": f"""
  SELECT canonical_company_id, min(start_date) AS first_engagement_date, max(coalesce(end_date, start_date)) AS most_recent_engagement_date,
         count(*) AS total_engagement_count, {_typed_count("engagement_type", "deal")}, {_typed_count("engagement_type", "membership")},
         {_typed_count("engagement_type", "project")}, {_typed_count("source_system", "hubspot")},
         {_typed_count("source_system", "officernd")}, {_typed_count("source_system", "bigtime")},
         count(DISTINCT source_system) AS engagement_source_system_count, {_texts("source_system")} AS engagement_source_systems,
         {_texts("engagement_type")} AS engagement_types, {_texts("engagement_category")} AS engagement_categories
  FROM mapped_ledger GROUP BY ALL""",
        "amounts": f"""
  SELECT canonical_company_id, {_exact("coalesce(amount, 0)")} AS total_source_reported_engagement_amount,
         {_typed_amount("deal")}, {_typed_amount("membership")}, {_typed_amount("project")},
         bool_or(requires_manual_review) AS has_engagement_manual_review_mapping, min(match_confidence) AS engagement_min_match_confidence
  FROM mapped_ledger GROUP BY ALL""",
        "ranked": """
  SELECT *, row_number() OVER (PARTITION BY canonical_company_id ORDER BY start_date DESC NULLS LAST, engagement_event_id) AS position,
         row_number() OVER (PARTITION BY canonical_company_id, engagement_type ORDER BY start_date DESC NULLS LAST, engagement_event_id) AS type_position
  FROM mapped_ledger""",
        "timelines": f"""
  SELECT canonical_company_id,
         {_items("engagement_category, engagement_type, " + _PROJECT_ITEM, 20, "position")} AS engagement_timeline,
         {_items("engagement_type, " + _PROJECT_ITEM, 10, "position")} AS recent_engagements
  FROM ranked GROUP BY ALL""",
        "typed": f"""
  SELECT canonical_company_id,
         {_items(_PROJECT_ITEM, 10, "type_position", "engagement_type = 'project'")} AS project_engagements,
         {_items(_ITEM, 10, "type_position", "engagement_type = 'deal'")} AS deal_engagements,
         {_items(_ITEM, 10, "type_position", "engagement_type = 'membership'")} AS membership_engagements
  FROM ranked GROUP BY ALL""",
    }
)

_COUNTS = (
    "current_active_memberships current_active_members current_total_mrr current_total_calculated_list_price "
    "current_total_calculated_discount_amount membership_month_count membership_officernd_company_count "
    "membership_location_count membership_month_active_membership_sum membership_month_active_member_sum "
    "membership_month_total_mrr total_engagement_count deal_engagement_count membership_engagement_count "
    "project_engagement_count hubspot_engagement_count officernd_engagement_count bigtime_engagement_count "
    "engagement_source_system_count total_source_reported_engagement_amount deal_amount membership_amount project_amount"
).split()
_ARRAYS = (
    "current_location_ids current_location_names current_location_codes current_membership_categories current_plan_ids "
    "current_plan_names all_membership_categories engagement_source_systems engagement_types engagement_categories "
    "engagement_timeline recent_engagements project_engagements deal_engagements membership_engagements"
).split()


def _mart() -> str:
    filled = [f"coalesce({name}, 0) AS {name}" for name in _COUNTS]
    filled += [f"coalesce({name}, '') AS {name}" for name in _ARRAYS]
    flags = [
        f"coalesce({t}_engagement_count, 0) > 0 AS has_{t}_engagement" for t in ("deal", "membership", "project")
    ]
    sure = ("d.min_match_confidence", "h.membership_min_match_confidence", "a.engagement_min_match_confidence")
    review = (
        "d.has_manual_review_mapping",
        "c.has_current_membership_manual_review_mapping",
        "h.has_membership_manual_review_mapping",
        "a.has_engagement_manual_review_mapping",
    )
    return f"""
  SELECT d.* EXCLUDE (has_manual_review_mapping, min_match_confidence), d.source_system_count > 1 AS is_multi_source_company,
         d.has_manual_review_mapping AS has_identity_manual_review_mapping, d.min_match_confidence AS identity_min_match_confidence,
         list_min([{", ".join(sure)}]) AS min_match_confidence,
         list_bool_or([{", ".join(f"coalesce({flag}, FALSE)" for flag in review)}]) AS has_any_manual_review_mapping,
         CASE WHEN current_active_memberships > 0 THEN 'active_member' WHEN first_membership_month IS NOT NULL THEN 'former_member'
              ELSE 'no_membership_record' END AS membership_status,
         coalesce(has_active_membership, FALSE) AS has_active_membership, first_membership_month, most_recent_membership_month,
         first_engagement_date, most_recent_engagement_date, coalesce(total_engagement_count, 0) > 0 AS has_engagement,
         {", ".join(flags + filled)}
  FROM dim d LEFT JOIN current c USING (canonical_company_id) LEFT JOIN history h USING (canonical_company_id)
       LEFT JOIN counts n USING (canonical_company_id) LEFT JOIN amounts a USING (canonical_company_id)
       LEFT JOIN timelines t USING (canonical_company_id) LEFT JOIN typed y USING (canonical_company_id)"""


_BLOCKS["mart"] = _mart()

_MEASURES = (
    "active_memberships active_members total_mrr total_calculated_list_price total_calculated_discount_amount"
).split()
_KEYS = "month_start company_id location_id membership_category plan_id".split()

_BLOCKS["existing"] = f"""
  SELECT month_start, CASE officernd_company_id WHEN '17' THEN '999999999' ELSE officernd_company_id END AS company_id,
         location_id, membership_category, plan_id, count(DISTINCT membership_id) AS active_memberships,
         count(DISTINCT member_id) + CASE officernd_company_id WHEN '11' THEN 2 ELSE 0 END AS active_members,
         {_exact("coalesce(discounted_price, price, 0)")} + CASE officernd_company_id WHEN '13' THEN 1 ELSE 0 END AS total_mrr,
         {_exact("coalesce(calculated_list_price, discounted_price, price, 0)")} AS total_calculated_list_price,
         {_exact("coalesce(calculated_discount_amount, 0)")} AS total_calculated_discount_amount
  FROM src_month
  WHERE contracted AND month_start <= {MONTH} AND NOT (officernd_company_id = '7' AND month(month_start) = 3)
  GROUP BY month_start, officernd_company_id, location_id, membership_category, plan_id"""
_BLOCKS["reconciled"] = f"""
  SELECT {", ".join(f"coalesce(p.{k}, e.{k}) AS {k}" for k in _KEYS)},
         {", ".join(f"p.{m} AS production_{m}, e.{m} AS existing_{m}" for m in _MEASURES)}
  FROM (SELECT *, officernd_company_id AS company_id FROM status) p
  FULL JOIN existing e ON {" AND ".join(f"p.{k} = e.{k}" for k in _KEYS)}"""
_BLOCKS["mapping_twice"] = (
    "SELECT source_system, source_company_id FROM src_mapping UNION ALL "
    "SELECT source_system, source_company_id FROM src_mapping WHERE requires_manual_review"
)


def _differs(measure: str) -> str:
    a, b = f"coalesce(production_{measure}, 0)", f"coalesce(existing_{measure}, 0)"
    return f"{a} <> {b}" if measure.startswith("active") else f"round({a}, 2) <> round({b}, 2)"


def _money_total(value: str) -> str:
    return f"CAST(CAST(round(SUM({value}), 2) AS VARCHAR) AS DOUBLE)"


_LEFT_MRR, _RIGHT_MRR = (
    f"CAST(CAST(coalesce({side}_total_mrr, 0) AS VARCHAR) AS DECIMAL(28,9))" for side in ("production", "existing")
)

# --- Expectation report ---------------------------------------------------------------

_REPORT_TABLES = {
    "bridge_company_source": "src_mapping",
    "dim_company": "dim",
    "fct_engagement_ledger": "ledger",
    "mart_membership_status": "status",
    "company_mart": "mart",
}


# The expectations, stated apart from those of the Spark code.
_NOT_NULL = {
    "bridge_company_source": (
        "source_system",
        "source_company_id",
        "requires_manual_review",
    ),
    "dim_company": (
        "canonical_company_id",
        "source_system_count",
        "has_manual_review_mapping",
    ),
    "fct_engagement_ledger": (
        "engagement_event_id",
        "canonical_company_id_is_null",
        "source_company_id",
        "source_system",
        "engagement_category",
        "engagement_type",
        "source_engagement_id",
        "requires_manual_review",
    ),
    "mart_membership_status": (
        "month_start",
        "canonical_company_id_is_null",
        "officernd_company_id",
        "location_id",
        "membership_category",
        "plan_id",
        "active_memberships",
        "active_members",
        "total_mrr",
        "total_calculated_list_price",
        "total_calculated_discount_amount",
        "has_manual_review_mapping",
    ),
    "company_mart": (
        "canonical_company_id",
        "source_system_count",
        "is_multi_source_company",
        "has_identity_manual_review_mapping",
        "has_any_manual_review_mapping",
        "membership_status",
        "has_active_membership",
        "current_active_memberships",
        "current_active_members",
        "current_total_mrr",
        "has_engagement",
        "has_deal_engagement",
        "has_membership_engagement",
        "has_project_engagement",
        "total_engagement_count",
    ),
}
_ACCEPTED = {
    "bridge_company_source": {
        "source_system": ("hubspot", "officernd", "bigtime"),
    },
    "dim_company": {
        "company_name_source": ("hubspot", "officernd", "bigtime"),
    },
    "fct_engagement_ledger": {
        "source_system": ("hubspot", "officernd", "bigtime"),
        "engagement_category": ("Business",),
        "engagement_type": ("deal", "membership", "project"),
    },
    "mart_membership_status": {},
    "company_mart": {
        "company_name_source": ("hubspot", "officernd", "bigtime"),
        "membership_status": ("active_member", "former_member", "no_membership_record"),
        "is_multi_source_company": (True, False),
        "has_identity_manual_review_mapping": (True, False),
        "has_any_manual_review_mapping": (True, False),
        "has_active_membership": (True, False),
        "has_engagement": (True, False),
        "has_deal_engagement": (True, False),
        "has_membership_engagement": (True, False),
        "has_project_engagement": (True, False),
    },
}
_UNIQUE = {
    "dim_company": (
        "canonical_company_id",
    ),
    "fct_engagement_ledger": (
        "engagement_event_id",
    ),
    "company_mart": (
        "canonical_company_id",
    ),
}
_UNIQUE_COMBINATION = {
    "bridge_company_source": (
        "canonical_company_id",
        "source_system",
        "source_company_id",
    ),
    "dim_company": (
        "canonical_company_id",
    ),
    "mart_membership_status": (
        "month_start",
        "officernd_company_id",
        "location_id",
        "membership_category",
        "plan_id",
    ),
}
_RELATED = (
    "bridge_company_source",
    "fct_engagement_ledger",
    "mart_membership_status",
    "company_mart",
)


def _report() -> str:
    rows = []

    def add(model: str, kind: str, column: str, count: str) -> None:
        rows.append(
            f"SELECT '{model}' AS model_name, '{kind}' AS expectation, '{column}' AS column_name, ({count}) AS failing_rows"
        )

    for model, table in _REPORT_TABLES.items():
        for column in _NOT_NULL[model]:
            add(model, "not_null", column, f"SELECT count(*) FROM {table} WHERE {column} IS NULL")
        for column, values in _ACCEPTED[model].items():
            listed = ", ".join(str(v).upper() if isinstance(v, bool) else f"'{v}'" for v in values)
            add(
                model,
                "accepted_values",
                column,
                f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({listed})",
            )
        for kind, checks in (("unique", _UNIQUE), ("unique_combination", _UNIQUE_COMBINATION)):
            if model not in checks:
                continue
            columns = ", ".join(checks[model])
            skip = f" WHERE {columns} IS NOT NULL" if kind == "unique" else ""
            add(
                model,
                kind,
                columns,
                f"SELECT count(*) FROM (SELECT {columns} FROM {table}{skip} GROUP BY ALL HAVING count(*) > 1)",
            )
        if model in _RELATED:
            add(
                model,
                "relationship",
                "canonical_company_id",
                f"SELECT count(*) FROM {table} WHERE canonical_company_id IS NOT NULL "
                "AND canonical_company_id NOT IN (SELECT canonical_company_id FROM dim)",
            )
    return " UNION ALL ".join(rows)


# --- Queries --------------------------------------------------------------------------

_TOTAL = "total_source_reported_engagement_amount, deal_amount, membership_amount, project_amount"
_FULL_EVENT = "partner_company_ids, partner_names"


def _unnested(fields: str, limit: int) -> str:
    shown = fields.replace("partner_company_ids, partner_names", _FULL_EVENT)
    return f"SELECT canonical_company_id, position, {shown} FROM ranked WHERE position <= {limit}"


def _mapped(block: str) -> str:
    return _mapped_events(block)


# Amounts a decimal can't hold, by bucket: NaN, infinite, both infinities, huge, tiny, none.
_ODD_AMOUNT = """CASE CAST(deal_id AS BIGINT) % 7
  WHEN 1 THEN CASE WHEN deal_amount > 1e5 THEN CAST('NaN' AS DOUBLE) ELSE deal_amount END
  WHEN 2 THEN CASE WHEN deal_amount > 1e5 THEN CAST('Infinity' AS DOUBLE) ELSE deal_amount END
  WHEN 3 THEN CASE WHEN deal_amount > 1e5 THEN CAST('Infinity' AS DOUBLE) ELSE CAST('-Infinity' AS DOUBLE) END
  WHEN 4 THEN CASE WHEN deal_amount > 1e5 THEN CAST(1e20 AS DOUBLE) ELSE CAST(-1e20 AS DOUBLE) END
  WHEN 5 THEN CAST(1 AS DOUBLE) / 17179869184
  WHEN 6 THEN NULL ELSE deal_amount END"""

_COVERAGE = """count(*) AS row_count, count(*) FILTER (WHERE canonical_company_id IS NULL) AS null_canonical_rows,
  count(*) FILTER (WHERE canonical_company_id IS NULL) / count(*) AS null_canonical_rate,
  count(*) FILTER (WHERE requires_manual_review) AS manual_review_rows"""
_RECONCILED = f"""count(*) AS reconciled_key_rows,
  count(*) FILTER (WHERE production_active_memberships IS NULL) AS missing_from_production,
  count(*) FILTER (WHERE existing_active_memberships IS NULL) AS missing_from_existing,
  {", ".join(f"CAST(sum(coalesce({s}_{m}, 0)) AS BIGINT) AS {s}_{m}" for m in _MEASURES[:2] for s in ("production", "existing"))},
  {_money_total(_LEFT_MRR)} AS production_total_mrr, {_money_total(_RIGHT_MRR)} AS existing_total_mrr,
  {_money_total(f"abs({_LEFT_MRR} - {_RIGHT_MRR})")} AS abs_total_mrr_diff"""

_SELECTS: dict[str, str] = {
    "bridge_source": "SELECT * FROM src_mapping",
    "bridge_lookup": """SELECT s.project_id, CAST(s.client_id AS VARCHAR) AS source_company_id, b.canonical_company_id,
  b.canonical_company_id IS NULL AS canonical_company_id_is_null, coalesce(b.requires_manual_review, TRUE) AS requires_manual_review,
  b.match_confidence
FROM src_service s LEFT JOIN src_mapping b ON b.source_system = 'bigtime' AND b.source_company_id = CAST(s.client_id AS VARCHAR)""",
    "id_rollup": "SELECT * FROM rollup",
    "owner_lookup": "SELECT * FROM owned",
    "representative_crm": "SELECT * FROM best_crm",
    "representative_workspace": "SELECT * FROM best_space",
    "representative_client": "SELECT * FROM best_client",
    "dim_company": "SELECT * FROM dim",
    "deal_events": _mapped("ev_deal"),
    "project_partners": "SELECT * FROM partners",
    "startup_project_events": _mapped("ev_project"),
    "membership_events": _mapped("ev_member"),
    "services_project_events": _mapped("ev_service"),
    "engagement_ledger": "SELECT * FROM ledger",
    "membership_month_rows": "SELECT * FROM month_rows",
    "membership_status": "SELECT * FROM status",
    "membership_status_future": "SELECT * FROM status_future",
    "current_membership": "SELECT * FROM current",
    "membership_history": "SELECT * FROM history",
    "engagement_counts": "SELECT * FROM counts",
    "engagement_amounts": "SELECT * FROM amounts",
    "money_totals": f"""SELECT bucket, {_exact("odd_amount")} AS total, count(*) AS deals FROM (
  SELECT CAST(deal_id AS BIGINT) % 7 AS bucket, {_ODD_AMOUNT} AS odd_amount FROM src_deal) GROUP BY ALL""",
    "engagement_timeline": _unnested("engagement_category, engagement_type, " + _PROJECT_ITEM, 20),
    "recent_engagements": _unnested("engagement_type, " + _PROJECT_ITEM, 10),
    "typed_engagements": "SELECT * FROM typed",
    "mapping_quality": """SELECT canonical_company_id, identity_min_match_confidence, min_match_confidence,
  has_identity_manual_review_mapping, has_any_manual_review_mapping FROM mart""",
    "membership_status_label": "SELECT canonical_company_id, membership_status, has_active_membership, current_active_memberships FROM mart",
    "company_mart": "SELECT * FROM mart",
    "clean_attributes": """SELECT company_id, nullif(company_name, '') AS company_name, nullif(company_domain, '') AS company_domain,
  nullif(industry, '') AS industry, nullif(property_city, '') AS property_city, nullif(property_country, '') AS property_country FROM src_crm""",
    "surrogate_key": "SELECT source_engagement_id AS membership_id, engagement_event_id AS event_key FROM ev_member",
    "status_normalise_deal": """SELECT deal_id, deal_status,
  CASE WHEN deal_status IN ('won', 'lost', 'open') THEN deal_status ELSE 'unknown' END AS engagement_status FROM src_deal""",
    "status_normalise_membership": """SELECT membership_id, engagement_status_raw AS membership_status, start_date AS period_start_date,
  end_date AS period_end_date, engagement_status FROM ev_member""",
    "distinct_sorted_arrays": f"""SELECT officernd_company_id AS company_id, {_texts("location_id")} AS location_ids,
  {_texts("nullif(membership_category, 'Uncategorized')")} AS membership_categories,
  {_texts("plan_id", "25")} AS first_plan_ids, {_texts("member_id", "25")} AS first_member_ids FROM src_month GROUP BY ALL""",
    "expect_not_null": """SELECT source_system, source_company_id, canonical_company_id FROM src_mapping
WHERE requires_manual_review IS NULL""",
    "expect_unique": """SELECT canonical_company_id, count(*) AS row_count FROM src_mapping WHERE canonical_company_id IS NOT NULL
GROUP BY ALL HAVING count(*) > 1""",
    "expect_unique_combination": """SELECT canonical_company_id, source_system, count(*) AS row_count FROM src_mapping
GROUP BY ALL HAVING count(*) > 1""",
    "expect_accepted_values": "SELECT deal_id, deal_status FROM src_deal WHERE deal_status NOT IN ('won', 'lost', 'open')",
    "expect_relationship": """SELECT * FROM src_deal_link l WHERE NOT EXISTS
  (SELECT 1 FROM src_mapping b WHERE b.source_system = 'hubspot' AND b.source_company_id = l.company_id)""",
    "expectation_report": _report(),
    "qa_duplicate_mappings": """SELECT source_system, source_company_id, count(*) AS row_count FROM mapping_twice GROUP BY ALL
HAVING count(*) > 1 ORDER BY row_count DESC, source_system, source_company_id LIMIT 100""",
    "qa_multi_id_groups": f"""SELECT canonical_company_id, source_system, count(DISTINCT source_company_id) AS source_company_id_count,
  {_texts("source_company_id", "20")} AS sample_source_company_ids, count(*) FILTER (WHERE requires_manual_review) AS manual_review_rows,
  min(match_confidence) AS min_match_confidence
FROM src_mapping GROUP BY ALL HAVING count(DISTINCT source_company_id) > 1
ORDER BY source_company_id_count DESC, canonical_company_id NULLS FIRST, source_system LIMIT 100""",
    "qa_ledger_null_rates": f"""SELECT source_system, {_COVERAGE}
FROM ledger WHERE NOT (source_system = 'hubspot' AND engagement_type = 'project') GROUP BY ALL""",
    "qa_dimension_health": """SELECT count(*) AS company_count, count(*) FILTER (WHERE canonical_company_id IS NULL) AS null_id_count,
  count(*) FILTER (WHERE coalesce(company_name, '') = '') AS blank_name_count,
  count(*) FILTER (WHERE has_manual_review_mapping) AS manual_review_count,
  count(*) FILTER (WHERE source_system_count > 1) AS multi_source_count FROM dim""",
    "qa_ledger_coverage": f"SELECT source_system, engagement_type, {_COVERAGE} FROM ledger GROUP BY ALL",
    "qa_month_coverage": f"""SELECT period, {_COVERAGE} FROM (
  SELECT 'past_current' AS period, canonical_company_id, has_manual_review_mapping AS requires_manual_review FROM status
  UNION ALL SELECT 'future', canonical_company_id, has_manual_review_mapping FROM status_future) GROUP BY ALL""",
    "reconcile_current_month": f"SELECT {_RECONCILED} FROM reconciled WHERE month_start = {MONTH}",
    "reconcile_membership": "SELECT * FROM reconciled",
    "reconcile_mismatches": f"""SELECT * FROM reconciled WHERE production_active_memberships IS NULL OR existing_active_memberships IS NULL
  OR {" OR ".join(_differs(m) for m in _MEASURES)}""",
    "reconcile_summary": f"SELECT {_RECONCILED} FROM reconciled",
    "smoke_duplicates": """SELECT canonical_company_id, count(*) AS row_count FROM (
  SELECT canonical_company_id FROM mart UNION ALL SELECT canonical_company_id FROM mart WHERE source_system_count = 3)
GROUP BY ALL HAVING count(*) > 1 ORDER BY canonical_company_id LIMIT 100""",
    "smoke_null_counts": """SELECT count(*) FILTER (WHERE canonical_company_id IS NULL) AS null_canonical_company_id_count,
  count(*) FILTER (WHERE company_name IS NULL) AS null_company_name_count FROM mart""",
    "smoke_row_counts": """SELECT 'company_mart' AS model_name, count(*) AS row_count FROM mart
UNION ALL SELECT 'dim_company', count(*) FROM dim""",
    "smoke_review_counts": """SELECT count(*) FILTER (WHERE has_any_manual_review_mapping) AS manual_review_company_count,
  count(*) FILTER (WHERE has_identity_manual_review_mapping) AS identity_manual_review_company_count FROM mart""",
    "smoke_status_distribution": f"""SELECT membership_status, count(*) AS company_count,
  CAST(sum(current_active_memberships) AS BIGINT) AS current_active_memberships,
  CAST(sum(current_active_members) AS BIGINT) AS current_active_members,
  {_money_total(_dec("current_total_mrr"))} AS current_total_mrr FROM mart GROUP BY ALL""",
    "smoke_engagement_distribution": " UNION ALL ".join(
        f"""SELECT '{t}' AS engagement_type, count(*) FILTER (WHERE has_{t}_engagement) AS companies_with_engagement_type,
  CAST(sum({t}_engagement_count) AS BIGINT) AS engagement_count FROM mart"""
        for t in ("deal", "membership", "project")
    ),
}


def _assemble(select: str) -> str:
    """Put the blocks a SELECT needs in front of it, inner ones first."""
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in _BLOCKS:
            if name not in ordered and re.search(rf"\b(?:FROM|JOIN) {name}\b", sql):
                need(_BLOCKS[name])
                ordered.append(name)

    need(select)
    if not ordered:
        return select
    blocks = ", ".join(f"{name} AS ({_BLOCKS[name]})" for name in ordered)
    return f"WITH {blocks}\n{select}"


ORACLE_SQL: dict[str, str] = {name: _assemble(select) for name, select in _SELECTS.items()}
