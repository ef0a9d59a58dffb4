"""JSON lines to typed rows with a rescue column.

Most lines are plain objects, which patterns of the JVM take apart as they are spelled: one pattern
those of nothing but scalars under names of the schema, others and Spark's parser the rest. Only what
is left, with escapes, white space inside nested values, arrays of records, repeated names or what
is no JSON, goes to a decoder in Python.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
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
    TimestampType,
)

from strata.catalog import quoted_text
from strata.functions.rescue import CORRUPT, NESTED, PLAIN_DATE, PLAIN_TIME, TOO_FINE, as_map, with_rescue
from strata.functions.scalars import SOURCE_FILE
from strata.session import worker_environment

INTEGER = re.compile(r"-?[0-9]+")
NUMBER = re.compile(r"-?([0-9]+)(?:\.([0-9]+))?(?:[eE]([-+]?[0-9]+))?")
#: Characters of a number, and of a text, inside a nested value beyond which Spark's parser refuses it.
LONGEST_NUMBER, LONGEST_TEXT = 300, 10_000_000
RECORD = "struct<fields:map<string,string>,unfit:array<string>,corrupt:string>"


class Number(str):
    """A number as it is spelled."""


class Members(list):
    """The (name, value) pairs of an object, in order."""

    def repeats(self) -> bool:
        return len({name for name, _ in self}) < len(self)


def refuse(constant: str) -> None:
    raise ValueError(f"{constant} is no JSON")


DECODER = json.JSONDecoder(
    object_pairs_hook=Members, parse_int=Number, parse_float=Number, parse_constant=refuse
)


def spelled(value: object) -> str:
    """JSON for a decoded value, numbers as they were."""
    if isinstance(value, Number):
        return str(value)
    if isinstance(value, Members):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{spelled(v)}" for k, v in value) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(spelled, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def text_of(value: object) -> str:
    return str(value) if isinstance(value, str) else spelled(value)


def holds(kind: DataType, value: object) -> bool:
    """Whether Spark's parser reads all of a value into a type."""
    if value is None:
        return True
    if isinstance(kind, StructType):
        known = {f.name: f.dataType for f in kind}
        return (
            isinstance(value, Members)
            and not value.repeats()
            and all(name in known and holds(known[name], v) for name, v in value)
        )
    if isinstance(kind, MapType):
        return (
            isinstance(value, Members)
            and not value.repeats()
            and isinstance(kind.keyType, StringType)
            and all(holds(kind.valueType, v) for _, v in value)
        )
    if isinstance(kind, ArrayType):
        return type(value) is list and all(holds(kind.elementType, v) for v in value)
    if isinstance(kind, StringType):
        return isinstance(value, bool) or isinstance(value, str) and holds_number_text(value)
    if isinstance(kind, BooleanType):
        return isinstance(value, bool)
    if isinstance(value, Number):
        return holds_number(kind, value)
    if isinstance(kind, DateType) and type(value) is str:
        return re.search(PLAIN_DATE, value) is not None
    if isinstance(kind, TimestampType) and type(value) is str:
        return re.search(PLAIN_TIME, value) is not None and re.search(TOO_FINE, value) is None
    return False


def holds_number_text(value: str) -> bool:
    if isinstance(value, Number):
        return len(value) <= LONGEST_NUMBER and INTEGER.fullmatch(value) is not None
    return len(value) <= LONGEST_TEXT


def digits_and_exponent(value: str) -> tuple[str, int] | None:
    """The digits of a number from the first to the last that is not zero, none for zero, and the
    power of ten they are times; None if the exponent is beyond all types."""
    whole, fraction, exponent = NUMBER.fullmatch(value).groups(default="")
    if len(exponent) > 6:
        return None
    digits = (whole + fraction).lstrip("0")
    kept = digits.rstrip("0")
    return kept, int(exponent or 0) - len(fraction) + len(digits) - len(kept)


def holds_number(kind: DataType, value: Number) -> bool:
    """By the digits as they are spelled, so that no arithmetic rounds or overflows."""
    parts = digits_and_exponent(value) if len(value) <= LONGEST_NUMBER else None
    if parts is None:
        return False
    digits, exponent = parts
    if isinstance(kind, IntegralType):
        bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}[kind.simpleString()]
        return INTEGER.fullmatch(value) is not None and -(2 ** (bits - 1)) <= int(value) < 2 ** (bits - 1)
    if isinstance(kind, DoubleType):
        return Decimal(value) == Decimal(repr(float(value)))
    if isinstance(kind, FloatType):
        return len(digits) <= 6 and (not digits or -30 < exponent + len(digits) <= 30)
    if isinstance(kind, DecimalType):
        return not digits or -exponent <= kind.scale and len(digits) + exponent <= kind.precision - kind.scale
    return False


def fits(kind: DataType, value: object) -> bool:
    """Whether a type holds a value; one that cannot be told is rescued, so that none stops a feed."""
    try:
        return holds(kind, value)
    except (ArithmeticError, ValueError, RecursionError):
        return False


def records(line: str) -> list[Members] | None:
    """The objects of a line; None if it is neither an object nor an array of objects, or if a name
    repeats in one."""
    try:
        found = DECODER.decode(line)
        line.encode() if "\\u" not in line else spelled(found).encode()  # no halves of characters
    except (ValueError, RecursionError):
        return None
    found = [found] if isinstance(found, Members) else found
    if type(found) is not list or not all(isinstance(r, Members) and not r.repeats() for r in found):
        return None
    return found


#: Patterns of what JSON is made of, without escapes and, but between the parts of a record, without
#: white space. All are possessive: the matcher neither recurses nor goes back, however long a line.
BLANK, PLAIN = r"[ \t\r\n]*+", r'[^"\\\x00-\x1F]*+'
ANY_NUMBER = r"-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][-+]?+[0-9]++)?+"
#: A whole number as the built-in parser writes it.
SHORT_NUMBER = r"(?:0|-?+[1-9][0-9]{0,17}+)(?![0-9.eE])"


def nested_value(depth: int) -> str:
    """A value whose objects and arrays go so deep, with numbers that keep their spelling."""
    scalar = rf'"{PLAIN}"|{SHORT_NUMBER}|true|false|null'
    if not depth:
        return f"(?:{scalar})"
    inner = nested_value(depth - 1)
    members = rf'\{{(?:"{PLAIN}":{inner}(?:,"{PLAIN}":{inner})*+)?+\}}'
    return rf"(?:{scalar}|{members}|\[(?:{inner}(?:,{inner})*+)?+\])"


def record_of(value: str) -> str:
    member = rf'"{PLAIN}"{BLANK}:{BLANK}{value}'
    return rf"\A{BLANK}\{{{BLANK}(?:{member}(?:{BLANK},{BLANK}{member})*+)?+{BLANK}\}}{BLANK}\z"


NESTED_VALUE = nested_value(2)
#: A record whose numbers the built-in parser spells as they are, and one whose own may be spelled otherwise.
SHORT_RECORD = record_of(NESTED_VALUE)
PLAIN_RECORD = record_of(rf"(?:{NESTED_VALUE}|{ANY_NUMBER})")
#: The numbers of such a record, to put between the quotes that their names have, when all members are
#: gone through.
NUMBERS = rf'("{PLAIN}"{BLANK}:{BLANK}{NESTED_VALUE})|("{PLAIN}("){BLANK}:{BLANK})({ANY_NUMBER})'
#: Types inside nested ones that Spark writes as they were spelled, if it holds them.
EXACT = (StructType, ArrayType, MapType, StringType, BooleanType, IntegralType, DoubleType, DateType)


def written_exactly(kind: DataType) -> bool:
    if not isinstance(kind, EXACT):
        return False
    if isinstance(kind, StructType):
        return all(written_exactly(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return written_exactly(kind.elementType)
    return not isinstance(kind, MapType) or isinstance(kind.keyType, StringType) and written_exactly(kind.valueType)


#: Stands between the values of a flat record while it is taken apart; no plain text holds it.
SEPARATOR = "\u0001"


def flat_names(schema: StructType) -> list[str]:
    """The columns that a flat record may have: no nested ones, and none whose name has to be escaped."""
    return [f.name for f in schema if not isinstance(f.dataType, NESTED) and re.fullmatch(PLAIN, f.name)]


def with_flat_values(lines: DataFrame, names: list[str]) -> DataFrame:
    """Adds ``flat``, the values under ``names`` as they are spelled, texts with their quotes and ''
    for those not there, of a line that has no other members, none twice, and no white space between
    them; else NULL. One match both tells and takes apart."""
    line = F.col("value")
    if not names:
        return lines.withColumn("flat", F.lit(None).cast("array<string>"))
    members = "|".join(rf'"{literal_pattern(n)}":("{PLAIN}"|{SHORT_NUMBER}|true|false)' for n in names)
    record = rf'\A\{{(?:(?:{members})(?:,(?=")|(?=\}}\z)))++\}}\z'
    values = SEPARATOR + SEPARATOR.join(f"${i + 1}" for i in range(len(names)))
    taken = F.regexp_replace(line, F.lit(record), F.lit(values))
    found = lines.withColumn("flat", F.when(line.startswith("{") & F.is_valid_utf8(line), taken))
    # What is no such record still begins as it did.
    found = found.withColumn("flat", F.when(F.col("flat").startswith(SEPARATOR), F.split(F.substr("flat", F.lit(2)), SEPARATOR)))
    # A name that repeats has one value. A text that begins with a colon counts as a member more.
    members = (F.octet_length(line) - F.octet_length(F.replace(line, F.lit('":'), F.lit("")))) / 2
    there = sum((F.when(F.col("flat")[i] == "", 0).otherwise(1) for i in range(len(names))), F.lit(0))
    return found.withColumn("flat", F.when(members == there, F.col("flat")))


def literal_pattern(text: str) -> str:
    return "".join(c if c.isalnum() or c in "_ " else f"\\x{{{ord(c):x}}}" for c in text)


def with_plain_fields(lines: DataFrame, nested: dict[str, DataType]) -> DataFrame:
    """Adds ``plain``, the fields of a line that is a plain record without repeated names, as the
    decoder would give them; else NULL. The value of a nested column must come out as it went in."""
    line = F.col("value")
    text = F.when(line.rlike(SHORT_RECORD), line).when(
        line.rlike(PLAIN_RECORD), F.regexp_replace(line, F.lit(NUMBERS), F.lit("$1$2$3$4$3"))
    )
    found = lines.withColumn("plain", F.when(F.is_valid_utf8(line), F.from_json(text, "map<string,string>")))
    # The parser keeps what repeats, and NULLs.
    once = F.size(F.array_distinct(F.map_keys("plain"))) == F.size("plain")
    found = found.withColumn("plain", F.when(once, F.map_filter("plain", lambda _, v: v.isNotNull())))
    for name, kind in nested.items():
        raw = F.col("plain")[name]
        same = F.to_json(F.from_json(raw, kind)) == raw if written_exactly(kind) else F.lit(False)
        found = found.withColumn("plain", F.when(raw.isNull() | same, F.col("plain")))
    return found


def decoded(nested: dict[str, DataType]) -> object:
    """A function of Arrow columns: the records of each line that is not NULL."""
    from pyspark.sql.functions import arrow_udf

    kind = pa.list_(
        pa.struct(
            [("fields", pa.map_(pa.string(), pa.string())), ("unfit", pa.list_(pa.string())), ("corrupt", pa.string())]
        )
    )

    def of(line: str) -> list[dict]:
        found = records(line)
        if found is None:
            return [{"fields": None, "unfit": [], "corrupt": line.encode("utf-8", "backslashreplace").decode()}]
        return [
            {
                "fields": [(k, text_of(v)) for k, v in record if v is not None],
                "unfit": [k for k, v in record if k in nested and not fits(nested[k], v)],
                "corrupt": None,
            }
            for record in found
        ]

    @arrow_udf(f"array<{RECORD}>")
    def run(lines: pa.Array) -> pa.Array:
        if lines.null_count == len(lines):
            return pa.nulls(len(lines), kind)
        rows = [None if raw is None else of(raw.decode("utf-8", "backslashreplace")) for raw in lines.to_pylist()]
        return pa.array(rows, kind)

    return run


def parsed_lines(lines: DataFrame, schema: StructType) -> DataFrame:
    """Rows of ``value``, ``source_file`` as records: ``flat``, the values of a flat one; of others
    ``fields``, ``unfit``, the nested columns that do not hold their value, and ``corrupt``, a line that
    is no record. One pass: a flat line is NULL to Spark's parser, and a plain one to the decoder."""
    worker_environment(lines.sparkSession)
    nested = {f.name: f.dataType for f in schema if isinstance(f.dataType, NESTED)}
    plain = F.array(
        F.struct(
            F.col("plain").alias("fields"),
            F.array().cast("array<string>").alias("unfit"),
            F.lit(None).cast("string").alias("corrupt"),
        )
    )
    hard: Column = F.when(F.col("plain").isNull(), F.col("value").cast("binary"))
    rows = with_flat_values(lines.filter(F.length(F.trim("value")) > 0), flat_names(schema))
    rows = rows.withColumn("value", F.when(F.col("flat").isNull(), F.col("value")))
    rows = with_plain_fields(rows, nested)
    rows = rows.withColumn("decoded", decoded(nested)(hard))
    # A flat record has its values beside it, and a record of nothing in the list.
    found = F.when(F.col("flat").isNotNull() | F.col("plain").isNotNull(), plain).otherwise(F.col("decoded"))
    return rows.select(SOURCE_FILE, "flat", F.inline(found))


def parse_json_lines(lines: DataFrame, schema: StructType) -> DataFrame:
    """Rows of ``value``, ``source_file`` to the columns of ``schema`` plus the rescue column.

    A line holds an object or an array of objects. Field names are matched with their case, and
    numbers keep their spelling. A line that is not JSON, or in which an object repeats a name,
    gives a row of NULLs with the whole line in the rescue column.
    """
    nested = {f.name for f in schema if isinstance(f.dataType, NESTED)}
    parsed = parsed_lines(lines, schema)
    places = {name: i for i, name in enumerate(flat_names(schema))}

    def raw(name: str) -> str:
        field = f"fields[{quoted_text(name)}]"
        if name not in places:
            return field
        value = f"flat[{places[name]}]"
        flat = f"IF({value} = '', NULL, trim(BOTH '\"' FROM {value}))"
        return f"IF(flat IS NULL, {field}, {flat})"

    def kept(field: StructField) -> str | None:
        return f"NOT array_contains(unfit, {quoted_text(field.name)})" if field.name in nested else None

    known = ", ".join(quoted_text(name) for name in schema.names)
    unknown = f"map_filter(fields, (name, _) -> name NOT IN ({known}))" if known else "fields"
    return with_rescue(
        parsed,
        schema,
        raw,
        extras=f"coalesce({unknown}, {as_map({CORRUPT: 'corrupt'})})",
        found="IF(flat IS NULL, size(fields), size(filter(flat, value -> value <> '')))",
        kept=kept,
    )
