"""CSV files to typed rows with a rescue column, matching columns by header name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.rescue import CORRUPT, as_map, how_many, with_rescue
from strata.functions.scalars import SOURCE_FILE
from strata.sources.schema import WIDEST_ROW, by_header, field_names, literal_path


def read_one_header(
    spark: SparkSession, paths: list[str], header: tuple[str, ...], schema: StructType, widest: int = WIDEST_ROW
) -> DataFrame:
    """Files that share a header, which the caller has looked up.

    Fields are read by position, all as text, so ``007`` and ``12.50`` stay as they are. A row with
    too many or too few fields also goes whole to the rescue column, under a name that no field has.
    The reader makes room for `widest` fields, and fails on a row of more.
    """
    names = field_names(header)
    corrupt = CORRUPT
    while corrupt in names:
        corrupt = f"_{corrupt}"
    places = [f"f{i}" for i in range(len(names))]
    text = StructType([StructField(place, StringType()) for place in (*places, "corrupt")])
    rows = (
        spark.read.schema(text)
        .options(header=True, enforceSchema=True, columnNameOfCorruptRecord="corrupt")
        .option("maxColumns", max(widest, 2 * len(names)))
        .csv([literal_path(p) for p in paths])
        .selectExpr(f"struct({', '.join(text.names)}) AS fields", f"_metadata.file_path AS {SOURCE_FILE}")
    )
    place_of = {name: f"fields.{place}" for name, place in zip(names, places, strict=True)}

    def raw(name: str) -> str:
        return place_of.get(name, "CAST(NULL AS STRING)")

    unknown = {name: place for name, place in place_of.items() if name not in schema.names}
    return with_rescue(
        rows,
        schema,
        raw,
        extras=as_map({**unknown, corrupt: "fields.corrupt"}),
        found=how_many([f"fields.{place}" for place in text.names]),
    )


def read_any_header(
    spark: SparkSession, paths: list[str], schema: StructType, widest: int = WIDEST_ROW
) -> DataFrame | None:
    """Files of any headers: one scan per distinct header. None if no file has rows."""
    scans = [
        read_one_header(spark, group, header, schema, widest)
        for header, group in by_header(spark, paths).items()
    ]
    return reduce(DataFrame.unionByName, scans) if scans else None


def too_wide(failure: Exception) -> bool:
    """Whether a reader failed for want of room for a row's fields."""
    return "maxColumns" in str(failure) or "TextParsingException" in str(failure)


def widest_row(spark: SparkSession, paths: list[str]) -> int:
    """A bound on the fields of a row of the files: one more than the commas of a line."""
    commas = F.length("value") - F.length(F.translate("value", ",", ""))
    return 1 + (spark.read.text([literal_path(p) for p in paths]).agg(F.max(commas)).first()[0] or 0)
