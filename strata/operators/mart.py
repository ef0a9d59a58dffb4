"""The denormalised order-line mart: three equi-joins and a computed price."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import total_price


# Fixed values in MartSpec: the data contract of the mart, its keys and columns.


@dataclass(frozen=True)
class MartSpec:
    """Join keys, output columns as (relation, column, output name), and the price columns.

    Relations are ``line``, ``header``, ``product`` and ``type``.
    """

    order_key: str = "order_id"
    product_key: str = "product_id"
    type_key: str = "product_type_id"
    columns: tuple[tuple[str, str, str], ...] = (
        ("line", "line_id", "line_id"),
        ("line", "order_id", "order_id"),
        ("header", "date", "order_date"),
        ("header", "time", "order_time"),
        ("type", "name", "product_name"),
        ("type", "category", "product_category"),
        ("product", "size", "size"),
        ("line", "quantity", "quantity"),
    )
    price: str = "price"
    quantity: str = "quantity"
    total: str = "total_price"


def join_headers(lines: DataFrame, headers: DataFrame, key: str) -> DataFrame:
    """Keep every line; lines without a header get NULL header columns."""
    on = F.col(f"line.{key}") == F.col(f"header.{key}")
    return lines.alias("line").join(headers.alias("header"), on, "left")


def join_products(lines: DataFrame, products: DataFrame, key: str) -> DataFrame:
    """Keep the lines whose product exists, once per version of the product."""
    on = F.col(f"line.{key}") == F.col(f"product.{key}")
    return lines.join(products.alias("product"), on)


def join_types(products: DataFrame, types: DataFrame, key: str) -> DataFrame:
    """Keep the products whose type exists, once per version of the type."""
    on = F.col(f"product.{key}") == F.col(f"type.{key}")
    return products.join(types.alias("type"), on)


def build_mart(
    lines: DataFrame,
    headers: DataFrame,
    products: DataFrame,
    types: DataFrame,
    spec: MartSpec = MartSpec(),
) -> DataFrame:
    """Lines with header, product and type columns.

    The joins use the keys alone, neither status nor dates: a line comes once per version of its
    product times versions of its type. The fact-to-fact join goes first, on the narrow lines,
    before the dimensions multiply them. Products meet their types before the lines meet either,
    so that lines are never shuffled by type, a key of few values, nor after they were multiplied.
    A dimension that Spark's own size check lets it broadcast needs no shuffle of the lines. No
    side carries a hint, so one that outgrows the threshold is sort-merged, and a hot key on the
    line side is split by the adaptive skew join.
    """
    joined = join_headers(lines, headers, spec.order_key)
    described = join_types(products.alias("product"), types, spec.type_key)
    on = F.col(f"line.{spec.product_key}") == F.col(f"product.{spec.product_key}")
    joined = joined.join(described, on)
    return joined.select(
        *[F.col(f"{side}.{column}").alias(name) for side, column, name in spec.columns],
        total_price(
            F.col(f"product.{spec.price}"), F.col(f"line.{spec.quantity}")
        ).alias(spec.total),
    )
