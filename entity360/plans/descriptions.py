"""Descriptions attached to published models and columns."""

from entity360.sources.schemas import (
    BRIDGE_SCHEMA,
    COMPANY_MART_SCHEMA,
    DIM_COMPANY_SCHEMA,
    LEDGER_SCHEMA,
    MEMBERSHIP_STATUS_SCHEMA,
)

MODEL_COMMENTS = {
    "bridge_company_source": "Which source records belong to which company. Unmapped records stay in.",
    "dim_company": "One row per company: ids in every system and display attributes.",
    "fct_engagement_ledger": "One row per deal, membership period or project of a company.",
    "mart_membership_status": "Contracted memberships per month, company, location, category and plan.",
    "company_mart": "One wide row per company, for reading without joins.",
}

# One text per column name; models share them.
_TEXTS = {
    "canonical_company_id": "Company id shared by all systems.",
    "canonical_company_id_is_null": "TRUE when no company is known for the source record.",
    "source_system": "System the record comes from.",
    "source_company_id": "Company or client id in its source system.",
    "source_company_name": "Company name in its source system.",
    "requires_manual_review": "TRUE when a person should look at the mapping.",
    "match_confidence": "How sure the mapping is, from 0 to 1.",
    "match_priority": "Rank of the matching rule.",
    "match_method": "Rule that made the mapping.",
    "match_detail": "What the rule matched on.",
    "_resolved_at": "When the mapping was decided.",
    "company_name": "Display name: first of CRM, workspace and services that has one.",
    "company_name_source": "System the display name comes from.",
    "company_domain": "Web domain in the CRM.",
    "hubspot_industry": "Industry in the CRM.",
    "hubspot_city": "City in the CRM.",
    "hubspot_country": "Country in the CRM.",
    "employee_count": "Employees, as the CRM has it.",
    "annual_revenue": "Yearly revenue, as the CRM has it.",
    "officernd_company_email": "E-mail in the workspace system.",
    "officernd_company_url": "Web address in the workspace system.",
    "officernd_company_status": "Status in the workspace system.",
    "officernd_company_type": "Type in the workspace system.",
    "officernd_company_tier": "Tier in the workspace system.",
    "officernd_location_id": "Home location in the workspace system.",
    "bigtime_client_legal_name": "Legal name in the services system.",
    "bigtime_client_code": "Client code in the services system.",
    "bigtime_client_type": "Client type in the services system.",
    "bigtime_city": "City in the services system.",
    "bigtime_state": "State in the services system.",
    "bigtime_country": "Country in the services system.",
    "primary_owner_id": "CRM owner of the company.",
    "primary_owner_name": "Name of the CRM owner.",
    "primary_owner_email": "E-mail of the CRM owner.",
    "hubspot_company_ids": "All CRM ids of the company.",
    "officernd_company_ids": "All workspace ids of the company.",
    "bigtime_client_ids": "All services client ids of the company.",
    "source_system_count": "Number of systems that know the company.",
    "has_manual_review_mapping": "TRUE when any mapping involved needs a review.",
    "min_match_confidence": "Lowest confidence of the mappings involved.",
    "engagement_event_id": "Hash of event type and source ids; stable between runs.",
    "engagement_category": "Broad kind of engagement.",
    "engagement_type": "Deal, membership or project.",
    "source_engagement_id": "Event id in its source system.",
    "engagement_name": "Name of the event in its source system.",
    "engagement_subtype": "Finer kind; its meaning depends on the source.",
    "engagement_status": "Status in common terms where they exist.",
    "engagement_status_raw": "Status as the source has it.",
    "start_date": "Start, or the best date known for it.",
    "end_date": "End, if there is one.",
    "amount": "Deal value, membership price or project budget.",
    "member_id": "Member of a membership.",
    "membership_id": "Membership id.",
    "program_name": "Offering a startup project belongs to.",
    "partner_company_ids": "CRM ids of a startup project's partners.",
    "partner_names": "Names of a startup project's partners.",
    "month_start": "First day of the month.",
    "officernd_company_id": "Workspace id of the company.",
    "location_id": "Location id.",
    "location_name": "Location name.",
    "location_code": "Short location code.",
    "membership_category": "Category; a missing one reads Uncategorized.",
    "plan_id": "Plan id.",
    "plan_name": "Plan name.",
    "active_memberships": "Distinct contracted memberships.",
    "active_members": "Distinct members; do not add up over groups.",
    "total_mrr": "Monthly revenue: discounted price, else price.",
    "total_calculated_list_price": "List price, else discounted price, else price.",
    "total_calculated_discount_amount": "Discounts granted.",
    "observed_membership_statuses": "Up to ten states seen in the group.",
    "is_multi_source_company": "TRUE when more than one system knows the company.",
    "has_identity_manual_review_mapping": "TRUE when a mapping of the company itself needs a review.",
    "identity_min_match_confidence": "Lowest confidence of the company's own mappings.",
    "has_any_manual_review_mapping": "TRUE when identity, membership or engagement needs a review.",
    "membership_status": "Active member, former member or no membership on record.",
    "has_active_membership": "TRUE when the current month has a membership row.",
    "current_active_memberships": "Memberships in the current month.",
    "current_active_members": "Members in the current month, added up over groups.",
    "current_total_mrr": "Revenue of the current month.",
    "has_engagement": "TRUE when the ledger knows the company.",
    "has_deal_engagement": "TRUE when the company has a deal.",
    "has_membership_engagement": "TRUE when the company has a membership period.",
    "has_project_engagement": "TRUE when the company has a project.",
    "total_engagement_count": "Ledger rows of the company.",
    "engagement_categories": "Engagement categories seen.",
    "engagement_timeline": "Twenty newest engagements.",
    "recent_engagements": "Ten newest engagements.",
    "project_engagements": "Ten newest projects.",
    "deal_engagements": "Ten newest deals.",
    "membership_engagements": "Ten newest membership periods.",
}

COLUMN_COMMENTS = {
    model: {name: _TEXTS[name] for name in schema.fieldNames() if name in _TEXTS}
    for model, schema in {
        "bridge_company_source": BRIDGE_SCHEMA,
        "dim_company": DIM_COMPANY_SCHEMA,
        "fct_engagement_ledger": LEDGER_SCHEMA,
        "mart_membership_status": MEMBERSHIP_STATUS_SCHEMA,
        "company_mart": COMPANY_MART_SCHEMA,
    }.items()
}
