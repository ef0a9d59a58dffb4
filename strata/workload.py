"""The engine's operators over the driver's tables: the registered queries.

Order lines come from ``lineitem``, headers from ``orders``, products and product types from
``part``. Queries that need files or tables of their own let Spark write them, from the whole
tables, below the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalog import (
    conform,
    create_namespaces,
    read_back,
    replace_table,
    row_count,
)
from strata.config import LayerConfig
from strata.functions.scalars import (
    clean_price,
    drop_technical,
    total_price,
    with_version_columns,
)
from strata.operators.mart import build_mart, join_headers, join_products, join_types
from strata.operators.scd2 import scd2_merge, staged_union
from strata.plans.medallion import Medallion, run_pipeline
from strata.plans.orders import (
    HEADERS_SCHEMA,
    LINES_SCHEMA,
    PRODUCTS_SCHEMA,
    TYPES_SCHEMA,
    clean_products,
    orders_pipeline,
)
from strata.session import shared_folder
from strata.streaming.dimensions import merge_dimension
from strata.streaming.facts import append_fact
from strata.streaming.ingest import ingest

FIRST_DAY = date(2024, 1, 1)
SECOND_DAY = date(2024, 2, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/strata-{uuid4().hex}"


#: Databases of the queries of this process, which their results read until `drop_scratch`.
MADE: list[str] = []


def new_layers(spark: SparkSession) -> LayerConfig:
    config = LayerConfig(root=scratch(spark), prefix=f"s{uuid4().hex[:12]}_")
    create_namespaces(spark, config)
    MADE.extend(config.databases)
    return config


def drop_scratch(spark: SparkSession) -> None:
    """Drop the databases that queries have made; their results can then no longer be read."""
    while MADE:
        spark.sql(f"DROP SCHEMA IF EXISTS {MADE.pop()} CASCADE")


# --- the model's relations, as typed columns of the driver's tables


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.col("o_orderkey") * 37 % 86400
    clock = [F.floor(second / 3600), F.floor(second / 60) % 60, second % 60]
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.concat_ws(":", *[F.lpad(part.cast("string"), 2, "0") for part in clock]).alias("time"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as a feed delivers them: prices are text with a currency sign."""
    size = F.when(F.col("p_size") <= 15, "S").when(F.col("p_size") <= 35, "M").otherwise("L")
    price = (F.col("p_retailprice") - 900).cast("decimal(4,2)")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("product_type_id"),
        size.alias("size"),
        F.concat(F.lit("$"), price.cast("string")).alias("price"),
        "p_size",
    )


def raw_types(spark: SparkSession, sf_dir: str, name: str = "first") -> DataFrame:
    pick = {"first": F.min, "last": F.max}[name]
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_type").alias("product_type_id"))
        .agg(pick("p_name").alias("name"), F.min("p_brand").alias("category"))
        .withColumn("ingredients", F.lit("flour, water, salt"))
    )


def deliver(rows: DataFrame, day: date) -> DataFrame:
    """The rows as a bronze table holds them, ingested on ``day``."""
    return rows.withColumns(
        {
            "_rescued_data": F.lit(None).cast("string"),
            "created_at": F.lit(day).cast("timestamp"),
            "source_file": F.lit(None).cast("string"),
        }
    )


def first_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First delivery: the small and middle sizes."""
    return raw_products(spark, sf_dir).filter("p_size <= 40").drop("p_size")


def second_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second delivery: the big sizes are new, the promoted products have a new price."""
    new_price = F.lit("99.99").cast("decimal(4,2)") - clean_price(F.col("price"))
    return (
        raw_products(spark, sf_dir)
        .filter("p_size > 40 OR product_type_id = 'PROMO'")
        .withColumn("price", F.concat(F.lit("$"), new_price.cast("decimal(4,2)").cast("string")))
        .drop("p_size")
    )


def product_batch(rows: DataFrame, day: date) -> DataFrame:
    return conform(with_version_columns(clean_products(deliver(rows, day))), PRODUCTS_SCHEMA)


def type_batch(rows: DataFrame, day: date) -> DataFrame:
    return conform(with_version_columns(deliver(rows, day)), TYPES_SCHEMA)


def one_version_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_batch(raw_products(spark, sf_dir).drop("p_size"), FIRST_DAY)


def one_version_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_batch(raw_types(spark, sf_dir), FIRST_DAY)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows of the same columns, and known to be none when the plan is made."""
    return df.filter(F.lit(False))


# --- mart


def gold_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mart(
        lines(spark, sf_dir),
        headers(spark, sf_dir),
        one_version_products(spark, sf_dir),
        one_version_types(spark, sf_dir),
    )


def gold_fanout_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mart(
        lines(spark, sf_dir),
        headers(spark, sf_dir),
        scd2_products(spark, sf_dir),
        scd2_types(spark, sf_dir),
    )


def gold_table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart in place of a plain table of its name, replaced once, read back."""
    name = new_layers(spark).table("gold", "order_lines")
    lines(spark, sf_dir).write.format("parquet").saveAsTable(name)
    replace_table(spark, name, gold_order_lines(spark, sf_dir).drop("total_price"))
    replace_table(spark, name, gold_order_lines(spark, sf_dir))
    return read_back(spark, name)


def left_join_missing_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents keep their row without a label."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    joined = join_headers(documents, table(spark, sf_dir, "labels"), "doc_id")
    return joined.select("line.*", "header.quality", "header.toxic")


def inner_join_missing_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label vanish."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    joined = join_products(documents.alias("line"), table(spark, sf_dir, "labels"), "doc_id")
    return joined.select("line.*", "product.quality", "product.toxic")


def inner_join_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = one_version_products(spark, sf_dir)
    joined = join_products(lines(spark, sf_dir).alias("line"), products, "product_id")
    return joined.select("line.line_id", "line.product_id", "product.size", "product.price")


def inner_join_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = one_version_products(spark, sf_dir).alias("product")
    joined = join_types(products, one_version_types(spark, sf_dir), "product_type_id")
    return joined.select("product.product_id", "type.name", "type.category")


def total_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = one_version_products(spark, sf_dir)
    joined = join_products(lines(spark, sf_dir).alias("line"), products, "product_id")
    return joined.select("line_id", total_price(F.col("price"), F.col("quantity")).alias("total"))


# --- cleaning, typing, counting


def clean_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Currency signs anywhere, rounding to cents, and values too big for the type."""
    amount = F.col("l_extendedprice").cast("decimal(12,2)")
    share = (F.col("l_discount") * 10).cast("decimal(6,3)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        clean_price(F.concat(F.lit(" $"), amount.cast("string"))).alias("big"),
        clean_price(F.concat(F.lit("$1$"), share.cast("string"))).alias("small"),
        clean_price(F.col("l_returnflag")).alias("word"),
    )


def typed_fact_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = lines(spark, sf_dir).withColumn("quantity", F.col("quantity").cast("int"))
    return conform(drop_technical(deliver(narrow, FIRST_DAY)), LINES_SCHEMA)


def typed_fact_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = deliver(headers(spark, sf_dir), FIRST_DAY)
    return conform(drop_technical(bronze), HEADERS_SCHEMA)


def row_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


# --- Type 2 dimensions as plain DataFrames


def scd2_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = product_batch(first_products(spark, sf_dir), FIRST_DAY)
    second = product_batch(second_products(spark, sf_dir), SECOND_DAY)
    loaded = scd2_merge(empty_like(first), first, ["product_id"], FIRST_DAY)
    return scd2_merge(loaded, second, ["product_id"], SECOND_DAY)


def scd2_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = type_batch(raw_types(spark, sf_dir), FIRST_DAY)
    second = type_batch(raw_types(spark, sf_dir, "last"), SECOND_DAY)
    loaded = scd2_merge(empty_like(first), first, ["product_type_id"], FIRST_DAY)
    return scd2_merge(loaded, second, ["product_type_id"], SECOND_DAY)


def scd2_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows again: every version closes and opens anew."""
    rows = raw_products(spark, sf_dir).drop("p_size")
    first, second = product_batch(rows, FIRST_DAY), product_batch(rows, SECOND_DAY)
    return scd2_merge(first, second, ["product_id"], SECOND_DAY)


def scd2_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels keyed by document: those a document lacks come without key, and twice."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    keyed = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left").select(
        F.when(F.col("quality").isNotNull(), F.col("doc_id")).alias("key"), "lang"
    )

    def batch(day: date) -> DataFrame:
        return with_version_columns(deliver(keyed, day))

    return scd2_merge(batch(FIRST_DAY), batch(SECOND_DAY), ["key"], SECOND_DAY)


def scd2_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension as big as a fact: orders, then the orders that have been settled."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    first = with_version_columns(deliver(orders, FIRST_DAY))
    settled = orders.filter("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("F"))
    second = with_version_columns(deliver(settled, SECOND_DAY))
    return scd2_merge(first, second, ["o_orderkey"], SECOND_DAY)


def staged_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_union(raw_products(spark, sf_dir).drop("p_size"), "product_id")


# --- streams


def stream_fact_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bronze table grows between two runs; each run appends what is new."""
    plan = orders_pipeline(new_layers(spark), "")
    fact = plan.facts[0]
    all_lines = deliver(lines(spark, sf_dir), FIRST_DAY)
    for part in ("quantity <= 25", "quantity > 25"):
        all_lines.filter(part).write.mode("append").format("parquet").saveAsTable(fact.source)
        append_fact(spark, fact)
    append_fact(spark, fact)
    return read_back(spark, fact.table)


def stream_scd2(spark: SparkSession, sf_dir: str, buckets: int = 1) -> DataFrame:
    """Two deliveries through the stream, then a run with nothing new."""
    dim = replace(orders_pipeline(new_layers(spark), "").dimensions[0], buckets=buckets)
    deliveries = {
        FIRST_DAY: first_products(spark, sf_dir),
        SECOND_DAY: second_products(spark, sf_dir),
    }
    for day, rows in deliveries.items():
        deliver(rows, day).write.mode("append").format("parquet").saveAsTable(dim.source)
        merge_dimension(spark, dim, day)
    merge_dimension(spark, dim, SECOND_DAY)
    return read_back(spark, dim.table)


def stream_scd2_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, rewriting bucket by bucket."""
    return stream_scd2(spark, sf_dir, buckets=16)


# --- files


def write_json(rows: DataFrame, path: str) -> None:
    rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("header", True).csv(path)


def ingest_json_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders fix the schema. Open ones add a nested field, pending ones hold a date
    that is none, and urgent pending ones break off in the middle of the line."""
    landing = scratch(spark)
    feed = orders_pipeline(new_layers(spark), landing).feeds[1]
    orders = headers(spark, sf_dir).join(
        table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "order_id"), "order_id"
    )
    finished, opened, pending = (orders.filter(F.col("o_orderstatus") == s) for s in "FOP")
    write_json(finished.select("order_id", "date", "time"), feed.path)
    ingest(spark, feed)
    customer = F.struct(F.col("o_custkey").alias("key")).alias("customer")
    write_json(opened.select("time", "date", "order_id", customer), feed.path)
    no_day = F.lit("soon").alias("date")
    whole = F.to_json(F.struct("order_id", no_day, F.col("time").alias("Time")))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    line = F.when(urgent, F.concat(F.lit('{"order_id":'), F.col("order_id"))).otherwise(whole)
    pending.select(line.alias("value")).write.mode("append").text(feed.path)
    ingest(spark, feed)
    ingest(spark, feed)

    def rescued(name: str, alias: str) -> Column:
        return F.get_json_object("_rescued_data", f"$.{name}").alias(alias)

    return spark.table(feed.table).select(
        "order_id",
        "date",
        "time",
        rescued("customer", "rescued_customer"),
        rescued("date", "rescued_date"),
        rescued("Time", "rescued_time"),
        rescued("_corrupt_record", "rescued_line"),
    )


def ingest_csv_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first files fix the schema; later ones have another column order, one column more,
    and sizes that are not numbers."""
    landing = scratch(spark)
    feed = orders_pipeline(new_layers(spark), landing).feeds[0]
    parts = raw_products(spark, sf_dir).withColumn("size", F.col("p_size"))
    write_csv(parts.filter("p_size <= 25").drop("p_size"), feed.path)
    ingest(spark, feed)
    later = parts.filter("p_size > 25").select(
        "price",
        F.concat("product_type_id", F.lit(", new")).alias("remark"),
        "product_id",
        F.when(F.col("p_size") > 40, F.concat("p_size", F.lit(" cm")))
        .otherwise(F.col("p_size").cast("string"))
        .alias("size"),
        "product_type_id",
    )
    write_csv(later, feed.path)
    write_csv(parts.filter("p_size <= 25").drop("p_size"), feed.path)
    ingest(spark, feed)
    ingest(spark, feed)

    def rescued(name: str) -> Column:
        return F.get_json_object("_rescued_data", f"$.{name}").alias(f"rescued_{name}")

    return spark.table(feed.table).select(
        F.col("product_id").cast("bigint").alias("product_id"),
        "product_type_id",
        F.col("size").cast("bigint").alias("size"),
        "price",
        rescued("remark"),
        rescued("size"),
    )


def rescue_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders fix the schema. The others have, in turn, a customer with a field more, a
    date with a time, an amount beyond double precision, a field that repeats, and a new field
    whose number is spelled with an exponent. Nothing is lost, and no spelling changes."""
    feed = replace(orders_pipeline(new_layers(spark), scratch(spark)).feeds[1], sample=None)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").cast("string").alias("day")
    )

    def line(tail: Column) -> Column:
        head = F.concat(F.lit('{"order_id":'), "o_orderkey", F.lit(','), tail, F.lit("}"))
        return head.alias("value")

    def fields(date: str = '"date":"%s"', customer: str = '"customer":{"key":%s}', amount: str = '"amount":1.5') -> Column:
        return F.concat_ws(",", F.format_string(date, "day"), F.format_string(customer, "o_custkey"), F.lit(amount))

    finished = F.col("o_orderstatus") == "F"
    orders.filter(finished).select(line(fields())).write.text(feed.path)
    ingest(spark, feed)
    turn = F.col("o_orderkey") % 5
    odd = (
        F.when(turn == 0, fields(customer='"customer":{"key":%s,"new":2.50}'))
        .when(turn == 1, fields(date='"date":"%s 10:11:12"'))
        .when(turn == 2, fields(amount='"amount":12345678901234567890.123456789'))
        .when(turn == 3, fields(amount='"z":1,"z":2'))
        .otherwise(fields(amount='"amount":12.50,"rate":1e3'))
    )
    orders.filter(~finished).select(line(odd)).write.mode("append").text(feed.path)
    ingest(spark, feed)

    def rescued(name: str, alias: str) -> Column:
        return F.get_json_object("_rescued_data", f"$.{name}").alias(f"rescued_{alias}")

    return spark.table(feed.table).select(
        "order_id",
        "date",
        F.col("customer.key").alias("customer_key"),
        "amount",
        *[rescued(name, name) for name in ("date", "customer", "amount", "rate")],
        rescued("_corrupt_record", "line"),
    )


def write_lines(rows: DataFrame, header: str, path: str) -> None:
    """Lines as they are, below a header line as it is."""
    plain = {"header": True, "sep": "\u0001", "quote": "\u0000", "escapeQuotes": False}
    rows.select(F.col("value").alias(header)).write.mode("append").options(**plain).csv(path)


def ingest_csv_odd_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean files first; then headers with an empty name, with a repeated name, and with nothing
    but names that no column has. A run over them, and another one, go through."""
    feed = orders_pipeline(new_layers(spark), scratch(spark)).feeds[0]
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("p_size"))
    turn = F.col("p_partkey") % 4

    def lines_of(n: int, *columns: Column) -> DataFrame:
        return parts.filter(turn == n).select(F.concat_ws(",", *columns).alias("value"))

    key, size = F.col("p_partkey"), F.col("p_size")
    write_lines(lines_of(0, key, size), "product_id,size", feed.path)
    ingest(spark, feed)
    write_lines(lines_of(1, key, F.lit("x"), size), "product_id,,size", feed.path)
    write_lines(lines_of(2, key, size, F.lit("again")), "product_id,size,size", feed.path)
    write_lines(lines_of(3, key, size), "PRODUCT_ID, size", feed.path)
    ingest(spark, feed)
    ingest(spark, feed)
    rescued = F.from_json("_rescued_data", "map<string,string>")
    names = {"_c1": "unnamed", "size_2": "repeated", "PRODUCT_ID": "other_case", " size": "with_space"}
    return spark.table(feed.table).select(
        "product_id", "size", *[rescued[name].alias(alias) for name, alias in names.items()]
    )


def rescue_nested_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose nested column has, in turn, a count of 5,000 digits, a rate of 10 to the power of
    a million, an amount with more decimals than its type, one of exactly 38 digits, and one spelled
    with an exponent. Each is typed exactly or rescued as it is spelled, and a second run goes through."""
    feed = replace(
        orders_pipeline(new_layers(spark), scratch(spark)).feeds[1],
        sample=None,
        hints="order_id BIGINT, money STRUCT<net: DECIMAL(38,18), rate: DOUBLE, count: BIGINT>",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")

    def line(money: Column) -> Column:
        return F.concat(F.lit('{"order_id":'), "o_orderkey", F.lit(',"money":{'), money, F.lit("}}")).alias("value")

    finished = F.col("o_orderstatus") == "F"
    orders.filter(finished).select(line(F.lit('"net":1.5,"rate":0.25,"count":7'))).write.text(feed.path)
    ingest(spark, feed)
    turn = F.col("o_orderkey") % 5
    odd = (
        F.when(turn == 0, F.concat(F.lit('"count":'), F.rpad(F.lit("9"), 5000, "9")))
        .when(turn == 1, F.lit('"rate":1e1000000'))
        .when(turn == 2, F.lit('"net":1234567890.12345678901234567890123'))
        .when(turn == 3, F.lit('"net":12345678901234567890.123456789012345678,"rate":0.1'))
        .otherwise(F.lit('"net":25e-18,"count":-9223372036854775808'))
    )
    orders.filter(~finished).select(line(odd)).write.mode("append").text(feed.path)
    ingest(spark, feed)
    ingest(spark, feed)
    return spark.table(feed.table).select(
        "order_id",
        F.col("money.net").alias("net"),
        F.col("money.rate").alias("rate"),
        F.col("money.count").alias("count"),
        F.from_json("_rescued_data", "map<string,string>")["money"].alias("rescued"),
    )


def ingest_csv_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as CSV, some rows of which have 30,000 fields too many; these are rescued whole, and
    another run goes through."""
    feed = orders_pipeline(new_layers(spark), scratch(spark)).feeds[0]
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("p_size"))
    more = F.when(F.col("p_partkey") % 100 == 7, F.repeat(F.lit(","), 30_000)).otherwise("")
    rows = parts.select(F.concat(F.concat_ws(",", "p_partkey", "p_size"), more).alias("value"), "p_partkey")
    write_lines(rows.filter("p_partkey % 2 = 0"), "product_id,size", feed.path)
    ingest(spark, feed)
    write_lines(rows.filter("p_partkey % 2 = 1"), "product_id,size", feed.path)
    ingest(spark, feed)
    ingest(spark, feed)
    whole = F.from_json("_rescued_data", "map<string,string>")["_corrupt_record"]
    return spark.table(feed.table).select("product_id", "size", F.md5(whole.cast("binary")).alias("rescued_md5"))


def sample_of_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten files or more, then those with a late field; the schema comes from the ten oldest, so the
    late field is rescued."""
    feed = orders_pipeline(new_layers(spark), scratch(spark)).feeds[1]
    rows = headers(spark, sf_dir)
    late = F.col("order_id") % 11 == 10
    early = rows.filter(F.coalesce(~late, F.lit(True)))
    parts = early.select(F.spark_partition_id()).distinct().count()
    write_json(early.repartition(max(10, parts)), feed.path)
    write_json(rows.filter(late).withColumn("late", F.lit(1)), feed.path)
    ingest(spark, feed)
    return spark.table(feed.table).select("order_id", F.get_json_object("_rescued_data", "$.late").alias("late"))


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a row came, and the folder of the file it came from."""
    plan, landing = landed_pipeline(spark)
    land_first(spark, sf_dir, landing, "headers")
    ingest(spark, plan.feeds[1])
    folder = F.regexp_extract("source_file", "([^/]+)/[^/]+$", 1)
    stamped = F.to_date("created_at") == F.current_date()
    return spark.table(plan.feeds[1].table).select("order_id", stamped.alias("stamped"), folder.alias("folder"))


def stream_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows a named stream has appended, with its name."""
    fact = orders_pipeline(new_layers(spark), "").facts[1]
    deliver(headers(spark, sf_dir), FIRST_DAY).write.format("parquet").saveAsTable(fact.source)
    query = append_fact(spark, fact)
    return read_back(spark, fact.table).select("order_id", F.lit(query.name).alias("query_name"))


def land_first(spark: SparkSession, sf_dir: str, landing: str, *names: str) -> None:
    """The first files of the named feeds, or of all."""
    writers = {
        "products": lambda path: write_csv(first_products(spark, sf_dir), path),
        "product_types": lambda path: write_csv(raw_types(spark, sf_dir), path),
        "lines": lambda path: write_json(lines(spark, sf_dir), path),
        "headers": lambda path: write_json(headers(spark, sf_dir), path),
    }
    for name in names or writers:
        writers[name](f"{landing}/{name}")


def land_second(spark: SparkSession, sf_dir: str, landing: str, *names: str) -> None:
    writers = {
        "products": lambda path: write_csv(second_products(spark, sf_dir), path),
        "product_types": lambda path: write_csv(raw_types(spark, sf_dir, "last"), path),
    }
    for name in names or writers:
        writers[name](f"{landing}/{name}")


def landed_pipeline(spark: SparkSession) -> tuple[Medallion, str]:
    landing = scratch(spark)
    return orders_pipeline(new_layers(spark), landing), landing


def feed_rows(name: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    """One feed into its bronze table, types as inferred. Clean files leave nothing to rescue."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        plan, landing = landed_pipeline(spark)
        [feed] = [f for f in plan.feeds if f.path == f"{landing}/{name}"]
        if name == "products":
            write_csv(raw_products(spark, sf_dir).drop("p_size"), feed.path)
        else:
            land_first(spark, sf_dir, landing, name)
        ingest(spark, feed)
        return read_back(spark, feed.table).select(*columns, "_rescued_data")

    return query


def silver_fact(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """One JSON feed through bronze into its typed silver table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        plan, landing = landed_pipeline(spark)
        [feed] = [f for f in plan.feeds if f.path == f"{landing}/{name}"]
        [fact] = [f for f in plan.facts if f.source == feed.table]
        land_first(spark, sf_dir, landing, name)
        ingest(spark, feed)
        append_fact(spark, fact)
        return read_back(spark, fact.table)

    return query


def silver_dimension(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Two deliveries of one CSV feed through bronze into its dimension. The dates are those of the
    run, so that a version that ended did so on the day it began, today."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        plan, landing = landed_pipeline(spark)
        [feed] = [f for f in plan.feeds if f.path == f"{landing}/{name}"]
        [dim] = [d for d in plan.dimensions if d.source == feed.table]
        for land in (land_first, land_second):
            land(spark, sf_dir, landing, name)
            ingest(spark, feed)
            merge_dimension(spark, dim)
        rows = read_back(spark, dim.table)
        today = F.when(F.col("end_date").isNotNull(), F.col("end_date") == F.current_date())
        same = F.col("end_date") == F.col("start_date")
        return rows.withColumns({"ended_today": today, "same_day": same}).drop("start_date", "end_date")

    return query


def files_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to gold in two runs; the second brings new versions of both dimensions."""
    plan, landing = landed_pipeline(spark)
    land_first(spark, sf_dir, landing)
    run_pipeline(spark, plan)
    land_second(spark, sf_dir, landing)
    run_pipeline(spark, plan)
    return read_back(spark, plan.gold.table)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gold_order_lines": gold_order_lines,
    "gold_fanout_versions": gold_fanout_versions,
    "gold_table_replace": gold_table_replace,
    "left_join_missing_header": left_join_missing_header,
    "inner_join_missing_product": inner_join_missing_product,
    "inner_join_product": inner_join_product,
    "inner_join_type": inner_join_type,
    "total_price": total_prices,
    "clean_price": clean_prices,
    "typed_fact_lines": typed_fact_lines,
    "typed_fact_headers": typed_fact_headers,
    "row_count_check": row_count_check,
    "scd2_products": scd2_products,
    "scd2_types": scd2_types,
    "scd2_redelivery": scd2_redelivery,
    "scd2_null_keys": scd2_null_keys,
    "scd2_orders": scd2_orders,
    "staged_union": staged_updates,
    "stream_fact_append": stream_fact_append,
    "stream_scd2": stream_scd2,
    "stream_scd2_buckets": stream_scd2_buckets,
    "ingest_json_rescue": ingest_json_rescue,
    "ingest_csv_rescue": ingest_csv_rescue,
    "rescue_lossless": rescue_lossless,
    "ingest_csv_odd_headers": ingest_csv_odd_headers,
    "rescue_nested_numbers": rescue_nested_numbers,
    "ingest_csv_wide_rows": ingest_csv_wide_rows,
    "sample_of_ten": sample_of_ten,
    "audit_columns": audit_columns,
    "stream_name": stream_name,
    "bronze_products": feed_rows("products", "product_id", "product_type_id", "size", "price"),
    "bronze_headers": feed_rows("headers", "order_id", "date", "time"),
    "bronze_lines": feed_rows("lines", "line_id", "order_id", "product_id", "quantity"),
    "bronze_product_types": feed_rows(
        "product_types", "product_type_id", "name", "category", "ingredients"
    ),
    "silver_lines": silver_fact("lines"),
    "silver_headers": silver_fact("headers"),
    "silver_product_types": silver_dimension("product_types"),
    "silver_products": silver_dimension("products"),
    "files_to_gold": files_to_gold,
}
