"""What the catalog accepts and refuses."""

import pytest
from pyspark.errors import AnalysisException

from conftest import rows


@pytest.fixture
def schema(spark, folder):
    name = "cat_" + folder.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{folder}/{name}'")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_managed_files_go_and_external_files_stay(spark, folder, schema):
    spark.sql(f"CREATE TABLE {schema}.m (width INT, length INT) USING parquet")
    spark.sql(f"CREATE TABLE {schema}.e (width INT, length INT) USING parquet LOCATION '{folder}/ext'")
    for name in "me":
        spark.sql(f"INSERT INTO {schema}.{name} VALUES (3, 2)")
        spark.sql(f"DROP TABLE {schema}.{name}")
        with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_NOT_FOUND"):
            spark.table(f"{schema}.{name}")
    assert rows(spark.read.parquet(f"{folder}/ext")) == [(3, 2)]


def test_overwrite_keeps_the_schema(spark, schema):
    spark.sql(f"CREATE TABLE {schema}.t USING parquet AS SELECT 1 AS a")
    spark.sql(f"INSERT OVERWRITE {schema}.t SELECT 2")
    assert rows(spark.table(f"{schema}.t")) == [(2,)]
    with pytest.raises(AnalysisException, match="INSERT_COLUMN_ARITY_MISMATCH"):
        spark.sql(f"INSERT OVERWRITE {schema}.t SELECT 3, current_timestamp()")


def test_global_views_need_their_qualifier(spark):
    spark.sql("CREATE GLOBAL TEMPORARY VIEW phones AS SELECT 1 AS id")
    assert spark.newSession().table("global_temp.phones").count() == 1
    with pytest.raises(AnalysisException):
        spark.table("phones")
    spark.sql("DROP VIEW global_temp.phones")


def test_temp_views_end_with_their_session(spark):
    spark.sql("CREATE TEMP VIEW only_here AS SELECT 1 AS id")
    with pytest.raises(AnalysisException):
        spark.newSession().table("only_here")
    spark.catalog.dropTempView("only_here")


def test_sql_functions(spark, schema):
    spark.sql(f"CREATE FUNCTION {schema}.half(x INT) RETURNS DOUBLE RETURN x / 2")
    assert spark.newSession().sql(f"SELECT {schema}.half(3)").first()[0] == 1.5
    text = "\n".join(r[0] for r in spark.sql(f"DESCRIBE FUNCTION EXTENDED {schema}.half").collect())
    assert "x / 2" in text
    spark.sql(f"DROP FUNCTION {schema}.half")
    with pytest.raises(AnalysisException):
        spark.sql(f"SELECT {schema}.half(3)")


def test_describe_and_properties(spark, schema):
    spark.sql(f"CREATE TABLE {schema}.t USING parquet COMMENT 'some rows' PARTITIONED BY (p) AS SELECT 1 AS a, 2 AS p")
    info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {schema}.t").collect()}
    assert info["Type"] == "MANAGED" and info["Provider"] == "parquet" and info["Comment"] == "some rows"
    spark.sql(f"ALTER TABLE {schema}.t SET TBLPROPERTIES ('owner_team' = 'x')")
    assert spark.sql(f"SHOW TBLPROPERTIES {schema}.t ('owner_team')").first()["value"] == "x"
    names = [r.col_name if hasattr(r, "col_name") else r[0] for r in spark.sql(f"DESC DATABASE EXTENDED {schema}").collect()]
    assert "Location" in names
    spark.sql(f"CREATE VIEW {schema}.v AS SELECT a FROM {schema}.t")
    assert [r.viewName for r in spark.sql(f"SHOW VIEWS IN {schema}").where("NOT isTemporary").collect()] == ["v"]


def test_ctas_forbids_a_declared_schema(spark, schema):
    with pytest.raises(Exception):
        spark.sql(f"CREATE TABLE {schema}.t (a INT) USING parquet AS SELECT 1 AS a")


def test_settings(spark):
    spark.sql("SET millrace.note = hello")
    assert spark.conf.get("millrace.note") == "hello"


def test_a_pivot_value_that_does_not_occur_is_null(spark):
    got = spark.sql("SELECT * FROM VALUES (1, 'a', 2), (1, 'a', 3) AS t(k, c, q) PIVOT (sum(q) FOR c IN ('a', 'b'))")
    assert rows(got) == [(1, 5, None)]


def test_struct_star_keeps_the_nested_struct(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'inner', named_struct('b', 2)) AS s").select("s.*", "s.inner.*")
    assert df.columns == ["a", "inner", "b"]


def test_explode_drops_empty_and_null_arrays(spark):
    df = spark.sql("SELECT * FROM VALUES (1, array(1, 2)), (2, array()), (3, NULL) AS t(id, a)")
    assert rows(df.selectExpr("id", "explode(a) AS x")) == [(1, 1), (1, 2)]
