from uuid import uuid4

import pytest

from strata.catalog import (
    conform,
    create_namespaces,
    create_table,
    overwrite_partitions,
    publish_view,
    properties,
    read_back,
    replace_table,
    row_count,
)
from strata.config import LayerConfig


@pytest.fixture
def config(spark, tmp_path):
    config = LayerConfig(str(tmp_path / "lake"), prefix=f"t{uuid4().hex[:8]}_")
    create_namespaces(spark, config)
    return config


def test_layout(tmp_path):
    config = LayerConfig("s3://b/lake", "s3://b/progress", "x_")
    assert config.databases["x_silver"] == "s3://b/lake/silver/tables"
    assert config.table("gold", "t") == "x_gold.t"
    assert config.checkpoint("bronze", "t") == "s3://b/progress/bronze/t"
    assert LayerConfig("r").checkpoint("bronze", "t") == "r/checkpoints/bronze/t"


def test_namespaces_may_exist(spark, config):
    create_namespaces(spark, config)
    for database, path in config.databases.items():
        assert spark.catalog.getDatabase(database).locationUri.endswith(path)


def test_create_table_keeps_rows(spark, config):
    name = config.table("silver", "t")
    create_table(spark, name, "id LONG, price DECIMAL(4,2)")
    spark.sql(f"INSERT INTO {name} VALUES (1, 2.5)")
    create_table(spark, name, "id LONG, price DECIMAL(4,2)")
    assert read_back(spark, name).dtypes == [("id", "bigint"), ("price", "decimal(4,2)")]
    assert read_back(spark, name).count() == 1


def test_table_with_other_columns_is_refused(spark, config):
    name = config.table("silver", "t")
    create_table(spark, name, "id LONG, part STRING", ("part",))
    create_table(spark, name, "id BIGINT, part STRING", ("part",))
    for other in ("id INT, part STRING", "part STRING, id LONG", "id LONG"):
        with pytest.raises(ValueError, match="exists with the columns"):
            create_table(spark, name, other)


def test_replace_changes_rows_and_schema_and_drops_old_versions(spark, config):
    name = config.table("gold", "t")
    replace_table(spark, name, spark.range(3))
    planned_before = spark.table(name)
    replace_table(spark, name, spark.range(5).selectExpr("id", "id * 2 AS twice"))
    assert planned_before.count() == 3
    assert spark.table(name).columns == ["id", "twice"] and spark.table(name).count() == 5
    replace_table(spark, name, spark.table(name).filter("id > 3"))
    assert spark.table(name).count() == 1
    kept = [r.tableName for r in spark.sql(f"SHOW TABLES IN {config.database('gold')}").collect()]
    assert len(kept) == 3


def test_failed_replace_leaves_the_old_table(spark, config):
    name = config.table("gold", "t")
    replace_table(spark, name, spark.range(3))
    with pytest.raises(Exception):
        replace_table(spark, name, spark.range(3).selectExpr("raise_error('no') AS id"))
    assert spark.table(name).count() == 3


def test_overwrite_touches_only_its_partitions(spark, config):
    name = config.table("silver", "p")
    create_table(spark, name, "v LONG, part STRING", ("part",))
    for part, n in (("a", 2), ("b", 3), ("a", 4)):
        overwrite_partitions(spark.range(n).selectExpr("id", f"'{part}'"), name)
    assert {r.part: r["count"] for r in spark.table(name).groupBy("part").count().collect()} == {"a": 4, "b": 3}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_conform_selects_and_casts(spark):
    df = spark.range(1).selectExpr("'x' AS extra", "'5' AS n", "id")
    assert conform(df, "id LONG, n INT").dtypes == [("id", "bigint"), ("n", "int")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(spark.sql("SELECT 'x' AS n"), "n INT").collect()


def test_view_marks(spark, config):
    name = config.table("gold", "v")
    assert properties(spark, name) == {}
    publish_view(spark, name, "SELECT 1 AS one", {"a.b": "1"})
    assert properties(spark, name)["a.b"] == "1"


def test_count_ignores_distinctness(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    assert [r.row_count for r in row_count(df).collect()] == [3]


def test_replace_takes_the_place_of_a_plain_table(spark, config):
    name = config.table("gold", "plain")
    spark.range(3).write.format("parquet").saveAsTable(name)
    replace_table(spark, name, spark.range(5).withColumnRenamed("id", "n"))
    assert spark.table(name).columns == ["n"] and spark.table(name).count() == 5
    replace_table(spark, name, spark.range(1), keep=2)
    assert spark.table(name).count() == 1
    left = [r.tableName for r in spark.sql(f"SHOW TABLES IN {config.database('gold')} LIKE 'plain__*'").collect()]
    assert len(left) == 3
