import pytest

from entity360.operators.publish import publish, resolve_materialization
from entity360.plans.product import build_models, publish_models
from entity360.sources import SchemaMismatch, conform_source, load_source
from entity360.sources.sample import AS_OF, SampleSources

FOLDER = "/root/testdata/sf0.001"


def test_conform_widens_and_reorders(spark):
    df = spark.createDataFrame([("x", 1, 2, "gone")], "property_name string, id int, property_hubspot_owner_id int, extra string")
    got = conform_source(df, "hubspot.company")
    assert got.columns == ["id", "property_hubspot_owner_id", "property_name"]
    assert got.first()["id"] == 1 and dict(got.dtypes)["id"] == "bigint"


def test_conform_names_every_problem(spark):
    df = spark.createDataFrame([("1", 2)], "id string, property_hubspot_owner_id bigint")
    with pytest.raises(SchemaMismatch, match="id: string, not bigint; property_name: missing"):
        conform_source(df, "hubspot.company")


def test_load_source_from_files_and_table(spark, tmp_path):
    rows = SampleSources(spark, FOLDER)["hubspot.owner"]
    rows.write.parquet(str(tmp_path / "owner"))
    rows.createOrReplaceTempView("owner_table")
    by_path = load_source(spark, "hubspot.owner", str(tmp_path / "owner"))
    by_table = load_source(spark, "hubspot.owner", table="owner_table")
    assert sorted(by_path.collect()) == sorted(by_table.collect())
    with pytest.raises(ValueError):
        load_source(spark, "hubspot.owner")


def test_materialization_fallback():
    assert resolve_materialization({}, "user_mart") == "view"
    assert resolve_materialization({"data": "table"}, "user_mart") == "table"
    assert resolve_materialization({"data": "table", "mart": "view"}, "user_mart") == "view"
    assert resolve_materialization({"user_mart": "table"}, "mart") == "view"


def test_publish_view_and_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, t string")
    view = publish(df, "pub_view", column_comments={"n": "a number"})
    assert view.schema["n"].metadata["comment"] == "a number"
    for rows in (df, df.limit(1)):
        table = publish(rows, "pub", "table", namespace="company_test", comment="it's a table", column_comments={"t": "text"})
        assert table.count() == rows.count()
    assert spark.catalog.getTable("company_test.pub").description == "it's a table"
    described = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE company_test.pub").collect()}
    assert described["t"] == "text"
    with pytest.raises(ValueError):
        publish(df, "pub", "stream")
    with pytest.raises(ValueError):
        publish(df, "pub", column_comments={"nope": "x"})


def test_publish_models_as_tables_equals_plain_build(spark):
    sources = SampleSources(spark, FOLDER)
    published = publish_models(sources, AS_OF, {"data": "table", "user_mart": "view"}, namespace="company_all")
    built = build_models(sources, AS_OF)
    assert list(published) == list(built)
    assert published["company_mart"].columns == built["company_mart"].columns
    assert sorted(map(str, published["company_mart"].collect())) == sorted(map(str, built["company_mart"].collect()))
    parts = spark.sql("SHOW PARTITIONS company_all.mart_membership_status").count()
    assert parts == built["mart_membership_status"].select("month_start").distinct().count()
