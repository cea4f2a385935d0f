"""Declared columns of the fourteen source tables and of the five models."""

from pyspark.sql import types as T

STRING = T.StringType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
BOOL = T.BooleanType()
DATE = T.DateType()
TIMESTAMP = T.TimestampType()
TIMESTAMP_NTZ = T.TimestampNTZType()
TEXTS = T.ArrayType(STRING)


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "int_cross_source_companies": _schema(
        ("canonical_company_id", STRING),
        ("source_system", STRING),
        ("source_company_id", STRING),
        ("source_company_name", STRING),
        ("requires_manual_review", BOOL),
        ("match_confidence", DOUBLE),
        ("match_priority", LONG),
        ("match_method", STRING),
        ("match_detail", STRING),
        ("_resolved_at", TIMESTAMP_NTZ),
    ),
    "stg_hubspot_companies": _schema(
        ("company_id", LONG),
        ("company_name", STRING),
        ("company_domain", STRING),
        ("industry", STRING),
        ("property_city", STRING),
        ("property_country", STRING),
        ("employee_count", DOUBLE),
        ("annual_revenue", DOUBLE),
        ("created_at", TIMESTAMP),
        ("updated_at", TIMESTAMP),
    ),
    "hubspot.company": _schema(
        ("id", LONG), ("property_hubspot_owner_id", LONG), ("property_name", STRING)
    ),
    "hubspot.owner": _schema(
        ("owner_id", LONG), ("first_name", STRING), ("last_name", STRING), ("email", STRING)
    ),
    "stg_officernd_companies": _schema(
        ("company_id", STRING),
        ("company_name", STRING),
        ("company_email", STRING),
        ("company_url", STRING),
        ("company_status", STRING),
        ("company_type", STRING),
        ("company_tier", STRING),
        ("location_id", STRING),
        ("start_date", DATE),
        ("modified_at", TIMESTAMP),
    ),
    "stg_bigtime_clients": _schema(
        ("client_id", LONG),
        ("client_name", STRING),
        ("client_legal_name", STRING),
        ("client_code", STRING),
        ("client_type", STRING),
        ("city", STRING),
        ("state", STRING),
        ("country", STRING),
        ("is_deleted", BOOL),
    ),
    "stg_hubspot_deals": _schema(
        ("deal_id", STRING),
        ("deal_name", STRING),
        ("deal_type", STRING),
        ("deal_status", STRING),
        ("work_start_date", TIMESTAMP),
        ("close_date", TIMESTAMP),
        ("created_at", TIMESTAMP),
        ("work_end_date", TIMESTAMP),
        ("deal_amount", DOUBLE),
    ),
    "stg_hubspot_deal_company": _schema(
        ("deal_id", STRING), ("company_id", STRING), ("category", STRING), ("type_id", LONG)
    ),
    "hubspot.projects": _schema(
        ("id", LONG),
        ("property_project_name", STRING),
        ("property_project_category", STRING),
        ("property_project_status", STRING),
        ("property_project_start_date", TIMESTAMP),
        ("property_project_end_date", TIMESTAMP),
        ("property_offering", STRING),
        ("_fivetran_deleted", BOOL),
    ),
    "hubspot.projects_to_company": _schema(
        ("from_id", LONG), ("to_id", LONG), ("type_id", LONG)
    ),
    "int_membership_detail": _schema(
        ("membership_id", STRING),
        ("assignment_id", STRING),
        ("period_start_date", DATE),
        ("period_end_date", DATE),
        ("company_id", STRING),
        ("membership_name", STRING),
        ("membership_category", STRING),
        ("membership_status", STRING),
        ("calculated_list_price", DOUBLE),
        ("discounted_price", DOUBLE),
        ("price", DOUBLE),
        ("member_id", STRING),
    ),
    "stg_bigtime_projects": _schema(
        ("project_id", LONG),
        ("client_id", LONG),
        ("project_name", STRING),
        ("production_status_name", STRING),
        ("is_inactive", BOOL),
        ("start_date", DATE),
        ("end_date", DATE),
        ("budget_fees", DOUBLE),
    ),
    "int_membership_months": _schema(
        ("month_start", DATE),
        ("company_id", STRING),
        ("location_id", STRING),
        ("location_name", STRING),
        ("location_code", STRING),
        ("membership_category", STRING),
        ("plan_id", STRING),
        ("plan_name", STRING),
        ("membership_status", STRING),
        ("member_id", STRING),
        ("membership_id", STRING),
        ("calculated_list_price", DOUBLE),
        ("discounted_price", DOUBLE),
        ("price", DOUBLE),
        ("calculated_discount_amount", DOUBLE),
        ("is_contracted_in_month", BOOL),
    ),
    "mart_membership_detail": _schema(
        ("month_start", DATE),
        ("company_id", STRING),
        ("location_id", STRING),
        ("membership_category", STRING),
        ("plan_id", STRING),
        ("active_memberships", LONG),
        ("active_members", LONG),
        ("total_mrr", DOUBLE),
        ("total_calculated_list_price", DOUBLE),
        ("total_calculated_discount_amount", DOUBLE),
    ),
}

BRIDGE_SCHEMA = SOURCE_SCHEMAS["int_cross_source_companies"]

LEDGER_SCHEMA = _schema(
    ("engagement_event_id", STRING),
    ("canonical_company_id", STRING),
    ("canonical_company_id_is_null", BOOL),
    ("source_company_id", STRING),
    ("source_system", STRING),
    ("engagement_category", STRING),
    ("engagement_type", STRING),
    ("source_engagement_id", STRING),
    ("engagement_name", STRING),
    ("engagement_subtype", STRING),
    ("engagement_status", STRING),
    ("engagement_status_raw", STRING),
    ("start_date", DATE),
    ("end_date", DATE),
    ("amount", DOUBLE),
    ("member_id", STRING),
    ("membership_id", STRING),
    ("program_name", STRING),
    ("partner_company_ids", TEXTS),
    ("partner_names", TEXTS),
    ("requires_manual_review", BOOL),
    ("match_confidence", DOUBLE),
)

MEMBERSHIP_STATUS_SCHEMA = _schema(
    ("month_start", DATE),
    ("canonical_company_id", STRING),
    ("canonical_company_id_is_null", BOOL),
    ("officernd_company_id", STRING),
    ("location_id", STRING),
    ("location_name", STRING),
    ("location_code", STRING),
    ("membership_category", STRING),
    ("plan_id", STRING),
    ("plan_name", STRING),
    ("active_memberships", LONG),
    ("active_members", LONG),
    ("total_mrr", DOUBLE),
    ("total_calculated_list_price", DOUBLE),
    ("total_calculated_discount_amount", DOUBLE),
    ("has_manual_review_mapping", BOOL),
    ("min_match_confidence", DOUBLE),
    ("observed_membership_statuses", TEXTS),
)

_DISPLAY = (
    ("company_name", STRING),
    ("company_name_source", STRING),
    ("company_domain", STRING),
    ("hubspot_industry", STRING),
    ("hubspot_city", STRING),
    ("hubspot_country", STRING),
    ("employee_count", DOUBLE),
    ("annual_revenue", DOUBLE),
    ("primary_owner_id", STRING),
    ("primary_owner_name", STRING),
    ("primary_owner_email", STRING),
    ("officernd_company_email", STRING),
    ("officernd_company_url", STRING),
    ("officernd_company_status", STRING),
    ("officernd_company_type", STRING),
    ("officernd_company_tier", STRING),
    ("officernd_location_id", STRING),
    ("bigtime_client_legal_name", STRING),
    ("bigtime_client_code", STRING),
    ("bigtime_client_type", STRING),
    ("bigtime_city", STRING),
    ("bigtime_state", STRING),
    ("bigtime_country", STRING),
)
_IDS = (
    ("hubspot_company_ids", TEXTS),
    ("officernd_company_ids", TEXTS),
    ("bigtime_client_ids", TEXTS),
    ("source_system_count", LONG),
)

DIM_COMPANY_SCHEMA = _schema(
    ("canonical_company_id", STRING),
    *_DISPLAY,
    *_IDS,
    ("has_manual_review_mapping", BOOL),
    ("min_match_confidence", DOUBLE),
)

_EVENT = (
    ("engagement_name", STRING),
    ("engagement_status", STRING),
    ("start_date", DATE),
    ("end_date", DATE),
    ("source_system", STRING),
)
_PROGRAM = (
    ("program_name", STRING),
    ("partner_company_ids", TEXTS),
    ("partner_names", TEXTS),
)
EVENT_ITEM = _schema(*_EVENT)
PROJECT_ITEM = _schema(*_EVENT, *_PROGRAM)
RECENT_ITEM = _schema(("engagement_type", STRING), *_EVENT, *_PROGRAM)
TIMELINE_ITEM = _schema(
    ("engagement_category", STRING), ("engagement_type", STRING), *_EVENT, *_PROGRAM
)

COMPANY_MART_SCHEMA = _schema(
    ("canonical_company_id", STRING),
    *_DISPLAY,
    *_IDS,
    ("is_multi_source_company", BOOL),
    ("has_identity_manual_review_mapping", BOOL),
    ("identity_min_match_confidence", DOUBLE),
    ("min_match_confidence", DOUBLE),
    ("has_any_manual_review_mapping", BOOL),
    ("membership_status", STRING),
    ("has_active_membership", BOOL),
    ("current_location_ids", TEXTS),
    ("current_location_names", TEXTS),
    ("current_location_codes", TEXTS),
    ("current_membership_categories", TEXTS),
    ("current_plan_ids", TEXTS),
    ("current_plan_names", TEXTS),
    ("current_active_memberships", LONG),
    ("current_active_members", LONG),
    ("current_total_mrr", DOUBLE),
    ("current_total_calculated_list_price", DOUBLE),
    ("current_total_calculated_discount_amount", DOUBLE),
    ("first_membership_month", DATE),
    ("most_recent_membership_month", DATE),
    ("membership_month_count", LONG),
    ("membership_officernd_company_count", LONG),
    ("membership_location_count", LONG),
    ("all_membership_categories", TEXTS),
    ("membership_month_active_membership_sum", LONG),
    ("membership_month_active_member_sum", LONG),
    ("membership_month_total_mrr", DOUBLE),
    ("first_engagement_date", DATE),
    ("most_recent_engagement_date", DATE),
    ("total_engagement_count", LONG),
    ("deal_engagement_count", LONG),
    ("membership_engagement_count", LONG),
    ("project_engagement_count", LONG),
    ("hubspot_engagement_count", LONG),
    ("officernd_engagement_count", LONG),
    ("bigtime_engagement_count", LONG),
    ("engagement_source_system_count", LONG),
    ("engagement_source_systems", TEXTS),
    ("engagement_types", TEXTS),
    ("engagement_categories", TEXTS),
    ("engagement_timeline", T.ArrayType(TIMELINE_ITEM)),
    ("recent_engagements", T.ArrayType(RECENT_ITEM)),
    ("project_engagements", T.ArrayType(PROJECT_ITEM)),
    ("deal_engagements", T.ArrayType(EVENT_ITEM)),
    ("membership_engagements", T.ArrayType(EVENT_ITEM)),
    ("has_engagement", BOOL),
    ("has_deal_engagement", BOOL),
    ("has_membership_engagement", BOOL),
    ("has_project_engagement", BOOL),
    ("total_source_reported_engagement_amount", DOUBLE),
    ("deal_amount", DOUBLE),
    ("membership_amount", DOUBLE),
    ("project_amount", DOUBLE),
)
