"""The order-line pipeline: two fact feeds, two dimension feeds, one mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.config import LayerConfig
from strata.functions.scalars import clean_price
from strata.plans.medallion import GoldSpec, Medallion
from strata.streaming.dimensions import DimensionSpec
from strata.streaming.facts import FactSpec
from strata.streaming.ingest import FeedSpec

# The data contract, columns and types of the silver tables.
LINES_SCHEMA = "line_id LONG, order_id LONG, product_id STRING, quantity LONG"
HEADERS_SCHEMA = "order_id BIGINT, date DATE, time STRING"
VERSION_SCHEMA = "start_date DATE, end_date DATE, status STRING"
PRODUCTS_SCHEMA = (
    f"product_id STRING, product_type_id STRING, size STRING, price DECIMAL(4,2), {VERSION_SCHEMA}"
)
TYPES_SCHEMA = (
    f"product_type_id STRING, name STRING, category STRING, ingredients STRING, {VERSION_SCHEMA}"
)


def clean_products(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("price", clean_price(F.col("price").cast("string")))


def orders_pipeline(config: LayerConfig, landing: str, product_buckets: int = 16) -> Medallion:
    """Feeds lie in ``landing``/lines, headers (JSON) and products, product_types (CSV).

    ``product_buckets`` is about the size of the active products over 256 MB; types are few.
    """

    def feed(name: str, file_format: str, **options: object) -> FeedSpec:
        return FeedSpec(
            file_format=file_format,
            path=f"{landing}/{name}",
            table=config.table("bronze", name),
            checkpoint=config.checkpoint("bronze", name),
            name=f"{name} bronze",
            **options,
        )

    def silver(name: str) -> dict[str, str]:
        return {
            "source": config.table("bronze", name),
            "table": config.table("silver", name),
            "checkpoint": config.checkpoint("silver", name),
            "name": f"{name} silver",
        }

    return Medallion(
        config=config,
        feeds=(
            feed("products", "csv", sample=10),
            # The feed's own hints.
            feed("headers", "json", sample=10, hints="order_id BIGINT, date DATE"),
            feed("lines", "json"),
            feed("product_types", "csv"),
        ),
        facts=(
            FactSpec(**silver("lines"), schema=LINES_SCHEMA),
            FactSpec(**silver("headers"), schema=HEADERS_SCHEMA),
        ),
        dimensions=(
            DimensionSpec(
                **silver("products"),
                schema=PRODUCTS_SCHEMA,
                key="product_id",
                clean=clean_products,
                buckets=product_buckets,
            ),
            DimensionSpec(
                **silver("product_types"), schema=TYPES_SCHEMA, key="product_type_id"
            ),
        ),
        gold=GoldSpec(
            lines=config.table("silver", "lines"),
            headers=config.table("silver", "headers"),
            products=config.table("silver", "products"),
            types=config.table("silver", "product_types"),
            table=config.table("gold", "order_lines"),
        ),
    )
