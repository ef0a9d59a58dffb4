"""The dimension merge against a literal MERGE of the staged rows, and its odd rules."""

from collections import Counter
from datetime import date

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.scd2 import close_versions, delivered_keys, scd2_merge, staged_union
from strata.session import session_conf

SCHEMA = "k string, v int, start_date date, end_date date, status string"
D1, D2, D3 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


def version(key, value, start, end=None, status="a"):
    return (key, value, start, end, status)


def merge(spark, target, batch, day):
    out = scd2_merge(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(batch, SCHEMA), ["k"], day
    )
    return Counter(tuple(r) for r in out.collect())


def test_change_closes_and_opens(spark):
    assert merge(spark, [version("a", 1, D1)], [version("a", 2, D2)], D2) == Counter(
        [version("a", 1, D1, D2, "i"), version("a", 2, D2)]
    )


def test_identical_row_opens_a_new_version(spark):
    assert merge(spark, [version("a", 1, D1)], [version("a", 1, D2)], D2) == Counter(
        [version("a", 1, D1, D2, "i"), version("a", 1, D2)]
    )


def test_two_updates_on_one_day(spark):
    assert merge(spark, [version("a", 1, D1)], [version("a", 2, D1)], D1) == Counter(
        [version("a", 1, D1, D1, "i"), version("a", 2, D1)]
    )


def test_absent_key_stays_and_closed_rows_are_left_alone(spark):
    old = [version("a", 0, D1, D1, "i"), version("a", 1, D1), version("b", 5, D1)]
    assert merge(spark, old, [version("a", 2, D2)], D3) == Counter(
        [old[0], version("a", 1, D1, D3, "i"), old[2], version("a", 2, D2)]
    )


def test_new_key_twice_then_both_close(spark):
    twice = [version("a", 1, D1), version("a", 2, D1)]
    assert merge(spark, [], twice, D1) == Counter(twice)
    assert merge(spark, twice, [version("a", 3, D2)], D2) == Counter(
        [version("a", 1, D1, D2, "i"), version("a", 2, D1, D2, "i"), version("a", 3, D2)]
    )


def test_active_key_twice_is_refused_however_the_result_is_used(spark):
    target = spark.createDataFrame([version("a", 1, D1)], SCHEMA)
    batch = spark.createDataFrame([version("a", 2, D2), version("a", 3, D2)], SCHEMA)
    out = scd2_merge(target, batch, ["k"], D2)
    for use in (out.collect, out.count, out.select("v").collect):
        with pytest.raises(Exception, match="more than one row of the batch updates .* a"):
            use()


def test_closed_key_twice_is_fine(spark):
    closed = version("a", 1, D1, D1, "i")
    twice = [version("a", 2, D2), version("a", 3, D2)]
    assert merge(spark, [closed], twice, D2) == Counter([closed, *twice])


def test_null_key_is_inserted_twice_and_never_closed(spark):
    row = version(None, 1, D1)
    assert merge(spark, [row], [version(None, 2, D2)], D2) == Counter(
        {row: 1, version(None, 2, D2): 2}
    )


def test_empty_batch(spark):
    assert merge(spark, [version("a", 1, D1)], [], D2) == Counter([version("a", 1, D1)])


def test_default_closing_day_is_today(spark):
    out = scd2_merge(
        spark.createDataFrame([version("a", 1, D1)], SCHEMA),
        spark.createDataFrame([version("a", 2, D2)], SCHEMA),
        ["k"],
    )
    today = spark.range(1).select(F.current_date()).first()[0]
    assert out.filter("status = 'i'").first().end_date == today


def test_composite_key(spark):
    schema = "x int, y int, start_date date, end_date date, status string"
    target = [(1, 1, D1, None, "a"), (1, 2, D1, None, "a"), (1, None, D1, None, "a")]
    batch = [(1, 2, D2, None, "a"), (1, None, D2, None, "a")]
    out = scd2_merge(
        spark.createDataFrame(target, schema), spark.createDataFrame(batch, schema), ["x", "y"], D2
    )
    assert Counter(tuple(r) for r in out.collect()) == Counter(
        {target[0]: 1, (1, 2, D1, D2, "i"): 1, target[2]: 1, batch[0]: 1, batch[1]: 2}
    )


def test_staged_union(spark):
    out = staged_union(spark.createDataFrame([("a", 1), (None, 2)], "k string, v int"), "k")
    assert Counter(tuple(r) for r in out.collect()) == Counter(
        {("a", 1, "a"): 1, ("a", 1, None): 1, (None, 2, None): 2}
    )


def test_hot_key_is_counted_before_the_shuffle(spark, capsys):
    batch = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    delivered = delivered_keys(batch, ["k"])
    delivered.explain()
    plan = capsys.readouterr().out
    assert plan.index("partial_count") > plan.index("Exchange")
    assert delivered.filter("_key0 = 'hot'").first()["_copies"] == 10000


@pytest.mark.parametrize("cached", [False, True])
@pytest.mark.parametrize("hot", ["hot", None])
def test_no_task_gets_all_of_a_hot_key(spark, tmp_path, capsys, hot, cached):
    """A third of the active versions have one key, or none, and too many keys were delivered to
    broadcast. The join splits the partition of the key, and spreads the rows without one."""
    rows = 200000
    ids = spark.range(0, rows, numPartitions=16)
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id").cast("string"))
    opened = {"start_date": F.lit(D1), "end_date": F.lit(None).cast("date"), "status": F.lit("a")}
    versions = ids.select(key.alias("k"), F.col("id").cast("int").alias("v")).withColumns(opened)
    versions.write.parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    batch = target.groupBy("k").agg(F.max("v").alias("v")).withColumns(opened)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with session_conf(spark, settings):
        keys = delivered_keys(batch, ["k"])
        if cached:
            keys = keys.persist()
            keys.count()
        closed = close_versions(target, keys, ["k"], D2).withColumn("task", F.spark_partition_id())
        found = closed.collect()
        closed.explain()
        keys.unpersist()
    assert Counter(r.status for r in found)["i"] == (rows if hot else rows - rows // 3 - 1)
    assert max(Counter(r.task for r in found).values()) < rows / 4
    assert ("skew=true" in capsys.readouterr().out) == bool(hot)


keys = st.sampled_from(["a", "b", "c", "d", None])
deliveries = st.lists(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=6), min_size=1, max_size=4)


def reference_merge(connection, batch, day):
    connection.execute("CREATE OR REPLACE TABLE b (k VARCHAR, v INT)")
    if batch:
        connection.executemany("INSERT INTO b VALUES (?, ?)", batch)
    connection.execute(
        f"""
        MERGE INTO t USING (SELECT *, k AS merge_id FROM b UNION ALL SELECT *, NULL FROM b) u
        ON t.k = u.merge_id AND t.status = 'a'
        WHEN MATCHED THEN UPDATE SET end_date = DATE '{day}', status = 'i'
        WHEN NOT MATCHED AND u.merge_id IS NULL THEN
            INSERT (k, v, start_date, end_date, status) VALUES (u.k, u.v, DATE '{day}', NULL, 'a')
        """
    )


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(deliveries)
def test_same_as_merge(spark, batches):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (k VARCHAR, v INT, start_date DATE, end_date DATE, status VARCHAR)")
    versions, rows_before = [], 0
    for n, batch in enumerate(batches):
        day = date(2024, 1, 1 + n)
        active = {r[0] for r in versions if r[4] == "a" and r[0] is not None}
        copies = Counter(k for k, _ in batch)
        delivered = [version(k, v, day) for k, v in batch]
        if any(copies[k] > 1 for k in active):
            with pytest.raises(Exception, match="more than one row"):
                merge(spark, versions, delivered, day)
            continue
        closed = Counter(r for r in versions if r[4] == "i")
        versions = list(merge(spark, versions, delivered, day).elements())
        reference_merge(connection, batch, day)
        assert Counter(versions) == Counter(connection.execute("SELECT * FROM t").fetchall())
        assert not closed - Counter(versions)
        assert len(versions) - rows_before == len(batch) + copies[None]
        rows_before = len(versions)


def test_names_with_dots_and_names_of_helpers(spark):
    schema = "`a.b` string, _copies int, _spread int, _key0 int, _copy int, start_date date, end_date date, status string"
    target = [("x", 1, 2, 3, 4, D1, None, "a"), ("y", 1, 2, 3, 4, D1, None, "a"), ("x", 0, 0, 0, 0, D1, D1, "i")]
    batch = [("x", 5, 6, 7, 8, D2, None, "a"), (None, 5, 6, 7, 8, D2, None, "a")]
    out = scd2_merge(spark.createDataFrame(target, schema), spark.createDataFrame(batch, schema), ["a.b"], D2)
    assert out.columns == spark.createDataFrame([], schema).columns
    assert Counter(tuple(r) for r in out.collect()) == Counter(
        {("x", 1, 2, 3, 4, D1, D2, "i"): 1, target[1]: 1, target[2]: 1, batch[0]: 1, batch[1]: 2}
    )


def test_only_active_rows_with_a_key_are_exchanged(spark, tmp_path, capsys):
    rows = spark.range(1000).selectExpr("IF(id % 4 = 0, NULL, CAST(id AS STRING)) AS k", "1 AS v", "DATE'2024-01-01' AS start_date",
                                        "CAST(NULL AS DATE) AS end_date", "IF(id % 2 = 0, 'a', 'i') AS status")
    rows.write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        close_versions(target, delivered_keys(target, ["k"]), ["k"], D2).explain("formatted")
    plan = capsys.readouterr().out
    filters = [line for line in plan.splitlines() if line.startswith("Condition") and "status" in line]
    assert any("= a" in f and "isnotnull(k" in f for f in filters)
    tree = plan.split("\n\n")[0]
    union = tree.index("Union")
    assert tree.count("Exchange") == tree[union:].count("Exchange") == 3
