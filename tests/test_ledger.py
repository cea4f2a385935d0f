from datetime import date

import pytest

from entity360.plans.engagement_ledger import (
    deal_events,
    engagement_ledger,
    membership_events,
    project_partners,
    services_project_events,
    startup_project_events,
)
from entity360.sources.schemas import LEDGER_SCHEMA
from tests.fixtures import AS_OF, at, bridge, collect, frame

DEALS = [
    {"deal_id": "d1", "deal_status": "won", "work_start_date": at(3), "close_date": at(2), "deal_amount": 5.0},
    {"deal_id": "d2", "deal_status": "Won", "created_at": at(9, 23)},
    {"deal_id": "d3"},
]
DEAL_LINKS = [
    {"deal_id": d, "company_id": c, "category": k, "type_id": t}
    for d, c, k, t in [
        ("d1", "1", "HUBSPOT_DEFINED", 5),
        ("d1", "3", "HUBSPOT_DEFINED", 5),
        ("d1", "4", "HUBSPOT_DEFINED", 6),
        ("d2", "4", "HUBSPOT_DEFINED", 5),
        ("d3", "1", "USER_DEFINED", 5),
        ("d9", "1", "HUBSPOT_DEFINED", 5),
    ]
]
PROJECTS = [
    {"id": 100, "property_project_status": None, "property_offering": "Studio"},
    {"id": 101, "_fivetran_deleted": True},
    {"id": 102, "_fivetran_deleted": False, "property_project_start_date": at(5)},
]
PROJECT_LINKS = [
    {"from_id": f, "to_id": t, "type_id": k}
    for f, t, k in [
        (100, 1, 105),
        (100, 3, 105),
        (101, 1, 105),
        (102, 77, 105),
        (100, 2, 107),
        (100, 10, 107),
        (100, 10, 107),
        (100, 55, 107),
        (100, None, 107),
    ]
]
COMPANIES = [{"id": 2, "property_name": "Two"}, {"id": 10, "property_name": "Ten"}]
DETAIL = [
    {"membership_id": "m1", "company_id": "o1", "membership_status": "active", "price": 3.0},
    {
        "membership_id": "m2",
        "company_id": "o9",
        "membership_status": "odd",
        "membership_category": "Desk",
        "period_end_date": date(2024, 1, 1),
        "discounted_price": 2.0,
        "price": 3.0,
        "assignment_id": "a",
    },
]
SERVICES = [
    {"project_id": 1, "client_id": 10, "is_inactive": None, "production_status_name": "", "budget_fees": 9.0},
    {"project_id": 2, "client_id": 99, "is_inactive": True},
]


def deals(spark):
    return frame(spark, "stg_hubspot_deals", DEALS), frame(spark, "stg_hubspot_deal_company", DEAL_LINKS)


def projects(spark):
    return (
        frame(spark, "hubspot.projects", PROJECTS),
        frame(spark, "hubspot.projects_to_company", PROJECT_LINKS),
        frame(spark, "hubspot.company", COMPANIES),
    )


def detail(spark):
    return frame(spark, "int_membership_detail", DETAIL)


def services(spark):
    return frame(spark, "stg_bigtime_projects", SERVICES)


def test_deal_events(spark):
    rows = collect(deal_events(*deals(spark), bridge(spark)), "source_engagement_id", "source_company_id")
    assert [(r["source_engagement_id"], r["source_company_id"]) for r in rows] == [
        ("d1", "1"),
        ("d1", "3"),
        ("d2", "4"),
    ]
    assert rows[0]["start_date"] == date(2024, 1, 3) and rows[0]["engagement_status"] == "won"
    assert rows[2]["start_date"] == date(2024, 1, 9)
    assert (rows[2]["engagement_status"], rows[2]["engagement_status_raw"]) == ("unknown", "Won")
    assert rows[2]["canonical_company_id_is_null"] is True
    assert rows[0]["partner_names"] == [] and rows[0]["member_id"] is None
    assert rows[0]["engagement_event_id"] != rows[1]["engagement_event_id"]


def test_project_partners(spark):
    rows = collect(project_partners(*projects(spark)[1:]))
    assert rows == [
        {"project_id": 100, "partner_company_ids": ["10", "2", "55"], "partner_names": ["Ten", "Two"]}
    ]


def test_startup_project_events(spark):
    rows = collect(startup_project_events(*projects(spark), bridge(spark)), "source_company_id")
    assert [(r["source_engagement_id"], r["source_company_id"]) for r in rows] == [
        ("100", "1"),
        ("100", "3"),
        ("102", "77"),
    ]
    assert rows[0]["engagement_status"] == "unknown" and rows[0]["program_name"] == "Studio"
    assert rows[0]["partner_company_ids"] == ["10", "2", "55"]
    assert rows[2]["partner_company_ids"] == [] and rows[2]["canonical_company_id"] is None


def test_membership_events(spark):
    rows = collect(membership_events(detail(spark), bridge(spark), AS_OF), "membership_id")
    assert rows[0]["engagement_subtype"] == "Uncategorized" and rows[0]["amount"] == 3.0
    assert rows[1]["engagement_status"] == "expired" and rows[1]["amount"] == 2.0
    assert rows[1]["requires_manual_review"] is True


def test_services_project_events(spark):
    rows = collect(services_project_events(services(spark), bridge(spark)), "source_engagement_id")
    assert (rows[0]["engagement_status"], rows[0]["engagement_status_raw"]) == ("active", None)
    assert (rows[1]["engagement_status"], rows[1]["engagement_status_raw"]) == ("inactive", "true")
    assert rows[0]["engagement_subtype"] is None and rows[0]["canonical_company_id"] == "A"


@pytest.fixture(scope="module")
def whole(spark):
    return engagement_ledger(
        *deals(spark), *projects(spark), detail(spark), services(spark), bridge(spark), AS_OF
    )


def test_ledger_is_the_union_of_its_branches(spark, whole):
    branches = [
        deal_events(*deals(spark), bridge(spark)),
        startup_project_events(*projects(spark), bridge(spark)),
        membership_events(detail(spark), bridge(spark), AS_OF),
        services_project_events(services(spark), bridge(spark)),
    ]
    expected = [r for b in branches for r in collect(b)]
    key = "engagement_event_id"
    assert collect(whole, key) == sorted(expected, key=lambda r: r[key])
    assert len({r[key] for r in expected}) == len(expected)


def test_ledger_schema(whole):
    assert [(f.name, f.dataType) for f in whole.schema] == [(f.name, f.dataType) for f in LEDGER_SCHEMA]
