"""Schema of a feed: inferred once from a sample, overlaid with hints, then frozen."""

from __future__ import annotations

import csv
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from strata.functions.rescue import CORRUPT, PLAIN_TIME
from strata.functions.scalars import TECHNICAL
from strata.session import map_batches, session_conf

# The columns of Spark's file listing source.
FILE_LISTING = "path string, modificationTime timestamp, length long, content binary"

# A pair of inferred types that has a wider common type other than text.
WIDER = {
    frozenset((IntegerType(), LongType())): LongType(),
    frozenset((IntegerType(), DoubleType())): DoubleType(),
    frozenset((LongType(), DoubleType())): DoubleType(),
    frozenset((DateType(), TimestampType())): TimestampType(),
}


def literal_path(path: str) -> str:
    """Escape the characters a reader would take for a file pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def sample_files(spark: SparkSession, path: str, sample: int) -> list[str]:
    """The ``sample`` oldest non-empty files of a folder. Only names and sizes are read, not contents."""
    if sample < 1:
        raise ValueError(f"a sample of {sample} files tells nothing")
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .filter("length > 0")
        .select("path", "modificationTime")
        .orderBy("modificationTime", "path")
    )
    # The job lists and does not read: a task per core, whatever the sizes of the files.
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": str(2**60)}):
        rows = listing.limit(sample).collect()
    return [row["path"] for row in rows]


def widen(left: DataType, right: DataType) -> DataType:
    if left == right or isinstance(right, NullType):
        return left
    if isinstance(left, NullType):
        return right
    return WIDER.get(frozenset((left, right)), StringType())


def merge_fields(schemas: Iterable[StructType]) -> StructType:
    """Union by name in order of appearance; conflicting types widen, at last to text.

    Of names that differ by case only the first becomes a column, and names the engine needs for
    itself become none: those fields are rescued.
    """
    merged: dict[str, DataType] = {}
    taken = {name.lower(): "" for name in TECHNICAL}
    for schema in schemas:
        for field in schema:
            if taken.setdefault(field.name.lower(), field.name) == field.name:
                merged[field.name] = widen(merged.get(field.name, NullType()), field.dataType)
    return StructType(
        [
            StructField(name, StringType() if isinstance(kind, NullType) else kind)
            for name, kind in merged.items()
        ]
    )


def with_hints(schema: StructType, hints: str | None) -> StructType:
    """Hinted types replace inferred ones; hinted columns that were not seen are added."""
    wanted = {f.name: f.dataType for f in StructType.fromDDL(hints)} if hints else {}
    fields = [StructField(f.name, wanted.pop(f.name, f.dataType)) for f in schema]
    return StructType(fields + [StructField(n, t) for n, t in wanted.items()])


@dataclass(frozen=True)
class Files:
    """What a schema is inferred from: a folder as it stands, with its subfolders, whose names the
    driver does not handle, or some files of it."""

    paths: list[str]
    folder: bool = False

    def options(self) -> dict[str, object]:
        return {"recursiveFileLookup": True} if self.folder else {}

    def names(self) -> list[str]:
        return self.paths if self.folder else [literal_path(p) for p in self.paths]


def infer_json(spark: SparkSession, files: Files) -> StructType:
    options = {"columnNameOfCorruptRecord": CORRUPT, **files.options()}
    schema = spark.read.options(**options).json(files.names()).schema
    return merge_fields([StructType([f for f in schema if f.name != CORRUPT])])


def split_header(line: str) -> list[str]:
    """The names in a header line; quotes and backslashes as in the rows."""
    line = line.removeprefix("\ufeff")
    if '"' not in line:
        return line.split(",")
    return next(csv.reader([line], escapechar="\\", strict=False))


def field_names(header: tuple[str, ...]) -> list[str]:
    """A name for each field of a file: its own, or where it has none or repeats another one, a
    name by its place, which no column has."""
    names: dict[str, None] = {}
    given = set(header)
    for place, name in enumerate(header):
        own = name if name.strip() else f"_c{place}"
        while own in names or own != name and own in given:
            own = f"{own}_{place}"
        names[own] = None
    return list(names)


#: Headers that are looked up at the same time.
SIDE_BY_SIDE = 16


def header_of(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """The names in the first line of a file that is not blank. Spark takes one row and stops, so
    that a buffer is read, not the file."""
    rows = spark.read.text(literal_path(path)).filter(F.regexp_like("value", F.lit(r"\S"))).take(1)
    return tuple(split_header(rows[0].value)) if rows else None


def headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """The header of each file that has one; a small job for each."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        found = pool.map(lambda path: header_of(spark, path), paths)
        return {path: header for path, header in zip(paths, found, strict=True) if header}


def by_header(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Group files by their column names; files without any drop out, they hold no rows."""
    found = headers(spark, paths)
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path in paths:
        if path in found:
            groups[found[path]].append(path)
    return dict(groups)


def header_table(spark: SparkSession, files: Files) -> DataFrame:
    """(path, changed, names): of each file that has a line that is not blank its time of change and
    its header's names, NULL for those that are no names of their own. One pass over first blocks."""
    lines = (
        spark.read.options(**files.options())
        .text(files.names())
        .select("value", "_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_block_start")
        .filter(F.regexp_like("value", F.lit(r"\S")) & (F.col("file_block_start") == 0))
        .withColumn("line", F.monotonically_increasing_id())
    )
    firsts = lines.groupBy(F.col("file_path").alias("path"), F.col("file_modification_time").alias("changed")).agg(
        F.min_by("value", "line").alias("header")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = []
            for line in batch.column(2).to_pylist():
                header = tuple(split_header(line))
                names.append([n if n == own else None for n, own in zip(header, field_names(header), strict=True)])
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["path", "changed", "names"])

    return map_batches(firsts, run, "path string, changed timestamp, names array<string>")


#: Kinds of texts in CSV, as bits, so that those of many texts add up by OR. A text is of the first
#: kind that reads it, as in Spark's own inference.
INT, LONG, WHOLE, REAL, DAY, MOMENT, TRUTH, TEXT = (1 << k for k in range(8))


def kind_of(value: Column) -> Column:
    def reads(kind: str) -> Column:
        return value.try_cast(kind).isNotNull()

    digits = F.length(F.regexp_replace(value, "^[-+]?0*", ""))
    whole = value.rlike(r"^[-+]?[0-9]+$")
    return (
        F.when(whole & reads("int"), INT)
        .when(whole & reads("bigint"), LONG)
        .when(whole & (digits <= 38), WHOLE)
        .when(reads("double"), REAL)
        .when(value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & reads("date"), DAY)
        .when(value.rlike(PLAIN_TIME) & reads("timestamp"), MOMENT)
        .when(F.lower(value).isin("true", "false"), TRUTH)
        .otherwise(TEXT)
    )


def type_of(kinds: int, digits: int) -> DataType:
    """The narrowest type that reads texts of these kinds; ``digits`` are those of whole numbers."""
    if not kinds:
        return NullType()
    if not kinds & ~(INT | LONG | WHOLE | REAL):
        if kinds & REAL:
            return DoubleType()
        if kinds & WHOLE:
            return DecimalType(max(digits, 20 if kinds & LONG else 10), 0)
        return LongType() if kinds & LONG else IntegerType()
    if not kinds & ~(DAY | MOMENT):
        return TimestampType() if kinds & MOMENT else DateType()
    return BooleanType() if kinds == TRUTH else StringType()


def infer_csv(spark: SparkSession, files: Files) -> StructType:
    """Types of all texts under a name, whatever place it has in which file; fields without a name of
    their own become no columns.

    Two jobs, however many files and headers: one over their first blocks, one over the fields by
    place. Kinds of texts are added up by file and place on the way, then meet the names of their
    file; the driver gets a row for each name.
    """
    heads = header_table(spark, files).persist()
    try:
        width = heads.agg(F.max(F.size("names"))).first()[0]
        if not width:
            return StructType()
        places = [f"f{i}" for i in range(width)]
        text = StructType([StructField(place, StringType()) for place in places])
        options = {"header": True, "enforceSchema": True, "maxColumns": max(WIDEST_ROW, 2 * width), **files.options()}
        fields = (
            spark.read.schema(text)
            .options(**options)
            .csv(files.names())
            .select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.array(*places)).alias("place", "value"))
            .filter("value <> ''")
        )
        kind, digits = kind_of(F.col("value")), F.length(F.regexp_replace("value", "^[-+]?0*", ""))
        by_place = fields.select("path", "place", kind.alias("kind"), digits.alias("digits")).groupBy("path", "place").agg(
            F.bit_or("kind").alias("kinds"), F.max(F.when(F.col("kind") == WHOLE, F.col("digits"))).alias("digits")
        )
        named = heads.select("path", "changed", F.posexplode("names").alias("place", "name")).filter("name IS NOT NULL")
        found = (
            named.join(by_place, ["path", "place"], "left")
            .groupBy("name")
            .agg(
                F.min(F.struct("changed", "path", "place")).alias("first"),
                F.coalesce(F.bit_or("kinds"), F.lit(0)).alias("kinds"),
                F.coalesce(F.max("digits"), F.lit(0)).alias("digits"),
            )
            .collect()
        )
    finally:
        heads.unpersist()
    found.sort(key=lambda row: row.first)
    return merge_fields([StructType([StructField(r.name, type_of(r.kinds, r.digits)) for r in found])])


#: Fields of a CSV row that a reader makes room for at first; see `csv_feed.widest_row`.
WIDEST_ROW = 100_000


def store_schema(spark: SparkSession, schema: StructType, location: str) -> None:
    stored: DataFrame = spark.createDataFrame([(schema.json(),)], "schema string")
    stored.coalesce(1).write.mode("overwrite").text(location)


def stored_schema(spark: SparkSession, location: str) -> StructType | None:
    try:
        lines = spark.read.text(location).collect()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return StructType.fromJson(json.loads(lines[0][0])) if lines else None


def frozen_schema(
    spark: SparkSession,
    file_format: str,
    path: str,
    location: str,
    sample: int | None = None,
    hints: str | None = None,
) -> StructType:
    """The stored schema of a feed, inferred and stored on the first run.

    Inference sets the case sensitivity of the session for a moment, so it belongs before any
    streams that run side by side.
    """
    schema = stored_schema(spark, location)
    if schema is None:
        paths = sample_files(spark, path, 1 if sample is None else sample)
        if not paths:
            raise ValueError(f"no files to infer a schema from in {path}")
        files = Files([path], folder=True) if sample is None else Files(paths)
        infer = {"csv": infer_csv, "json": infer_json}[file_format]
        with session_conf(spark, {"spark.sql.caseSensitive": "true"}):
            schema = with_hints(infer(spark, files), hints)
        store_schema(spark, schema, location)
    return schema
