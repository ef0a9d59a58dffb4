"""Typed columns plus a rescue column, from raw text values.

Nothing a file holds is lost: a value that its column cannot hold as it is, and a field no column
exists for, go to the rescue column as JSON, together with the path of the file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from strata.catalog import quoted, quoted_text
from strata.functions.scalars import RESCUED, SOURCE_FILE

CORRUPT = "_corrupt_record"
FILE_PATH = "_file_path"
NESTED = (StructType, ArrayType, MapType)

# Decimal digits that a binary number surely keeps.
SURE_DIGITS = {FloatType: 6, DoubleType: 15}

# Texts that a cast reads without loss.
PLAIN_NUMBER = r"^\s*[-+]?[0-9]*\.?([0-9]*)\s*$"
PLAIN_DATE = r"^\s*[-+]?[0-9]{4,7}-[0-9]{1,2}-[0-9]{1,2}\s*$"
PLAIN_TIME = r"^\s*[-+]?[0-9]{4,6}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$"
TOO_FINE = r"\.[0-9]{7,}"
ZONE = r"[0-9]\s*([Zz]|[A-Za-z]+.*|[-+][0-9]{1,2}(:?[0-9]{2})?)\s*$"


def parse_text(raw: str, to: DataType) -> str:
    """SQL that reads the text ``raw`` as ``to``, or NULL."""
    if isinstance(to, StringType):
        return raw
    if isinstance(to, NESTED):
        return f"from_json({raw}, {quoted_text(to.simpleString())})"
    return f"try_cast({raw} AS {to.simpleString()})"


def digits_of(raw: str) -> str:
    """SQL for the number of digits that count in the text of a number."""
    return f"length(ltrim('0', regexp_replace({raw}, '[eE].*|[^0-9]', '')))"


def keeps(raw: str, typed: str, to: DataType) -> str:
    """SQL that tells whether ``typed`` says all that the text ``raw`` does.

    Numbers are compared as numbers: signs, leading zeros and zeros after the last decimal are no
    loss. Dates must be whole and nothing more, times no finer than microseconds.
    """

    def like(pattern: str) -> str:
        return f"{raw} RLIKE {quoted_text(pattern)}"

    if isinstance(to, (StringType, IntegralType)):
        return f"{typed} IS NOT NULL"
    if isinstance(to, (FloatType, DoubleType)):
        exact = f"CAST({typed} AS DECIMAL(38,18)) = try_cast({raw} AS DECIMAL(38,18))"
        fraction = f"length(regexp_extract({raw}, {quoted_text(PLAIN_NUMBER)}, 1)) <= 18"
        sure = f"{digits_of(raw)} <= {SURE_DIGITS[type(to)]}"
        inside = f"abs({typed}) BETWEEN 1e-30 AND 1e30 OR {digits_of(raw)} = 0"
        return f"({inside}) AND ({sure} OR {like(PLAIN_NUMBER)} AND {fraction} AND {exact})"
    if isinstance(to, DecimalType):
        fraction = f"rtrim('0', regexp_extract({raw}, {quoted_text(PLAIN_NUMBER)}, 1))"
        same = f"{digits_of(raw)} <= 15 AND CAST({typed} AS DOUBLE) = try_cast({raw} AS DOUBLE)"
        plain = f"IF({like(PLAIN_NUMBER)}, length({fraction}) <= {to.scale}, {same})"
        return f"({typed} IS NOT NULL AND {plain})"
    if isinstance(to, BooleanType):
        return f"lower(trim({raw})) IN ('true', 'false')"
    if isinstance(to, DateType):
        return f"({typed} IS NOT NULL AND {like(PLAIN_DATE)})"
    if isinstance(to, (TimestampType, TimestampNTZType)):
        zone = f" AND NOT {like(ZONE)}" if isinstance(to, TimestampNTZType) else ""
        return f"({typed} IS NOT NULL AND {like(PLAIN_TIME)} AND NOT {like(TOO_FINE)}{zone})"
    if isinstance(to, NESTED):
        return f"to_json({typed}) = {raw}"
    return f"CAST({typed} AS STRING) = {raw}"


def how_many(values: list[str]) -> str:
    """SQL that counts the values that are not NULL; a shallow sum, however many there are."""
    counts = [f"IF({value} IS NULL, 0, 1)" for value in values] or ["0"]
    while len(counts) > 1:
        counts = [f"({' + '.join(counts[i : i + 16])})" for i in range(0, len(counts), 16)]
    return counts[0]


def as_map(entries: dict[str, str]) -> str:
    """SQL for a map from names to text values."""
    pairs = ", ".join(f"{quoted_text(name)}, {value}" for name, value in entries.items())
    return f"CAST(map({pairs}) AS MAP<STRING, STRING>)"


def with_rescue(
    df: DataFrame,
    schema: StructType,
    raw: Callable[[str], str],
    extras: str,
    found: str,
    kept: Callable[[StructField], str | None] = lambda field: None,
) -> DataFrame:
    """Project ``df`` onto ``schema``, ``_rescued_data`` and ``source_file``.

    All expressions are SQL text, which keeps the plans of wide feeds quick to build.
    ``raw(name)`` is the text found for a column; ``extras`` is a map of the fields that have no
    column (NULL values in it are ignored). ``found`` counts the values of the row, or is NULL if
    unknown: where as many came out typed, there is nothing to rescue and no map is built.
    ``kept`` may give its own test of whether a field's column holds all of its text.
    """

    def typed(field: StructField) -> str:
        if isinstance(field.dataType, StringType):
            return raw(field.name)
        value = parse_text(raw(field.name), field.dataType)
        test = kept(field) or keeps(raw(field.name), value, field.dataType)
        return f"IF({test}, {value}, NULL)"

    values = {f.name: typed(f) for f in schema}
    own = df.selectExpr("*", *[f"{value} AS {quoted(f'_typed_{i}')}" for i, value in enumerate(values.values())])
    columns = {name: quoted(f"_typed_{i}") for i, name in enumerate(values)}
    misfits = {
        f.name: f"IF({columns[f.name]} IS NULL, {raw(f.name)}, NULL)"
        for f in schema
        if not isinstance(f.dataType, StringType)
    }
    left = f"map_filter(map_concat({extras}, {as_map(misfits)}), (_, value) -> value IS NOT NULL)"
    clean = f"{found} <=> {how_many(list(columns.values()))}"
    # A field that is itself called like the path entry wins; the path is in source_file as well.
    path = as_map({FILE_PATH: SOURCE_FILE})
    path = f"map_filter({path}, (name, _) -> NOT map_contains_key({RESCUED}, name))"
    return own.selectExpr(
        *[f"{column} AS {quoted(name)}" for name, column in columns.items()],
        f"IF({clean}, NULL, {left}) AS {RESCUED}",
        SOURCE_FILE,
    ).selectExpr(
        *[quoted(name) for name in values],
        f"IF(size({RESCUED}) > 0, to_json(map_concat({RESCUED}, {path})), NULL) AS {RESCUED}",
        SOURCE_FILE,
    )
