from datetime import date

from entity360.operators import bridge_lookup, bridge_source
from entity360.plans.company_dimension import (
    dim_company,
    id_rollup,
    representative_client,
    representative_crm,
    representative_workspace,
    with_owner,
)
from tests.fixtures import at, bridge, collect, frame, link


def test_bridge_source_keeps_unmapped_rows(spark):
    assert bridge_source(bridge(spark)).where("canonical_company_id IS NULL").count() == 2


def test_bridge_lookup_defaults(spark):
    events = spark.createDataFrame([("3",), ("4",), ("99",), (None,), ("1",)], "id string")
    rows = {r["id"]: r for r in collect(bridge_lookup(events, bridge(spark), "hubspot", "id"))}
    assert len(rows) == 5
    assert rows["3"]["canonical_company_id"] == "B" and not rows["3"]["canonical_company_id_is_null"]
    assert rows["4"]["canonical_company_id_is_null"] and rows["4"]["match_confidence"] == 0.1
    # No bridge row, and a bridge row without a flag: both need a review.
    for key in ("99", None, "1"):
        assert rows[key]["requires_manual_review"] is True


def test_bridge_lookup_by_column(spark):
    events = spark.createDataFrame([("hubspot", "1"), ("bigtime", "1")], "system string, id string")
    found = bridge_lookup(events, bridge(spark), events["system"], "id")
    assert [r["canonical_company_id"] for r in collect(found, "system")] == [None, "A"]


def test_id_rollup(spark):
    rows = {r["canonical_company_id"]: r for r in collect(id_rollup(bridge(spark)))}
    assert set(rows) == {"A", "B", "C", "D"}
    a = rows["A"]
    assert a["hubspot_company_ids"] == ["1", "2"]
    assert a["officernd_company_ids"] == ["o1"] and a["bigtime_client_ids"] == ["10"]
    assert a["source_system_count"] == 3
    # A NULL flag is no review here.
    assert a["has_manual_review_mapping"] is False and a["min_match_confidence"] == 0.8
    assert rows["B"]["has_manual_review_mapping"] is True
    # Empty arrays, never NULL; no confidence known.
    assert rows["D"]["hubspot_company_ids"] == [] and rows["D"]["min_match_confidence"] is None


def test_id_rollup_keeps_duplicate_ids_and_other_systems(spark):
    rows = [link("hubspot", "2", "A"), link("hubspot", "10", "A"), link("hubspot", "2", "A"), link("erp", "x", "A")]
    got = collect(id_rollup(bridge(spark, rows)))[0]
    assert got["hubspot_company_ids"] == ["10", "2", "2"]
    assert got["source_system_count"] == 2


def crm(spark, *rows):
    return frame(spark, "stg_hubspot_companies", list(rows))


RAW = [{"id": 1, "property_hubspot_owner_id": 7}, {"id": 2}, {"id": 3, "property_hubspot_owner_id": 8}]
OWNERS = [{"owner_id": 7, "first_name": "Ada", "email": ""}, {"owner_id": 8}]


def owner_tables(spark, owners=OWNERS):
    return frame(spark, "hubspot.company", RAW), frame(spark, "hubspot.owner", owners)


def test_owner_lookup(spark):
    companies = crm(spark, *[{"company_id": i} for i in (1, 2, 3, 4)])
    rows = {r["company_id"]: r for r in collect(with_owner(companies, *owner_tables(spark)))}
    assert rows[1]["primary_owner_name"] == "Ada" and rows[1]["primary_owner_email"] is None
    assert rows[2]["primary_owner_id"] is None
    assert rows[3]["primary_owner_id"] == "8" and rows[3]["primary_owner_name"] is None
    assert rows[4]["primary_owner_id"] is None


def test_representative_crm_order(spark):
    links = bridge(spark, [link("hubspot", str(i), "A") for i in (1, 2, 3, 10)])

    def best(*rows):
        got = collect(representative_crm(links, crm(spark, *rows), *owner_tables(spark)))
        assert len(got) == 1
        return got[0]["source_company_id"]

    named = {"company_id": 1, "company_name": "x"}
    newer_blank = {"company_id": 2, "company_name": "", "updated_at": at(9)}
    assert best(named, newer_blank) == "1"
    dated = {"company_id": 3, "company_name": "y", "updated_at": at(1)}
    assert best(named, dated) == "3"
    # Ties go to the id as text: '10' sorts before '3'.
    assert best(dated, {**dated, "company_id": 10}) == "10"


def test_representative_crm_repeated_owner_is_stable(spark):
    links = bridge(spark, [link("hubspot", "1", "A")])
    owners = [{"owner_id": 7, "email": "z@x"}, {"owner_id": 7, "email": "a@x"}]
    got = collect(
        representative_crm(links, crm(spark, {"company_id": 1}), *owner_tables(spark, owners))
    )
    assert [r["primary_owner_email"] for r in got] == ["a@x"]


def test_representative_workspace_order(spark):
    links = bridge(spark, [link("officernd", f"o{i}", "A") for i in range(4)])

    def best(*rows):
        got = collect(representative_workspace(links, frame(spark, "stg_officernd_companies", list(rows))))
        return got[0]["source_company_id"]

    active = {"company_id": "o1", "company_status": "active", "modified_at": at(1), "company_name": "b"}
    assert best({"company_id": "o0", "modified_at": at(9)}, active) == "o1"
    assert best(active, {**active, "company_id": "o2", "modified_at": at(2)}) == "o2"
    # Among ties a NULL name wins over any other.
    assert best(active, {**active, "company_id": "o3", "company_name": None}) == "o3"
    assert best(active, {**active, "company_id": "o2", "company_name": "A"}) == "o2"


def test_representative_client_order(spark):
    links = bridge(spark, [link("bigtime", str(i), "A") for i in (1, 2, 3)])

    def best(*rows):
        got = collect(representative_client(links, frame(spark, "stg_bigtime_clients", list(rows))))
        return got[0]["source_company_id"]

    gone = {"client_id": 1, "client_name": "a", "is_deleted": True}
    blank = {"client_id": 2, "client_name": ""}
    named = {"client_id": 3, "client_name": "z", "is_deleted": False}
    assert best(gone, blank) == "2"
    assert best(gone, blank, named) == "3"


def test_dim_company(spark):
    companies = crm(
        spark,
        {"company_id": 1, "company_name": "", "industry": "", "employee_count": 5.0},
        {"company_id": 3, "company_name": "Bee"},
    )
    spaces = frame(
        spark,
        "stg_officernd_companies",
        [{"company_id": "o1", "company_name": "Space A", "start_date": date(2024, 1, 1)}],
    )
    clients = frame(spark, "stg_bigtime_clients", [{"client_id": 20, "client_name": "Dee", "city": ""}])
    dim = dim_company(bridge(spark), companies, *owner_tables(spark), spaces, clients)
    rows = {r["canonical_company_id"]: r for r in collect(dim)}
    assert len(dim.columns) == 30 and set(rows) == {"A", "B", "C", "D"}
    assert (rows["A"]["company_name"], rows["A"]["company_name_source"]) == ("Space A", "officernd")
    assert rows["A"]["employee_count"] == 5.0 and rows["A"]["hubspot_industry"] is None
    assert (rows["B"]["company_name"], rows["B"]["company_name_source"]) == ("Bee", "hubspot")
    assert (rows["C"]["company_name"], rows["C"]["company_name_source"]) == (None, None)
    assert (rows["D"]["company_name_source"], rows["D"]["bigtime_city"]) == ("bigtime", None)
