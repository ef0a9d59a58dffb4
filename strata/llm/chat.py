"""Chat formatting, with DataFrame functions only: the fingerprint of a record's nested field paths
selects a declared mapping to canonical turns; a template marks the turns and the loss mask."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN = "array<struct<role:string,text:string>>"
#: The marks of the template, and the control strings that texts must not hold.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: The inside of a JSON string; a text value after its name, if it has one; neighbours of one shape in a
#: list. All are possessive: the matcher does not recurse, so that no text is too long for it.
INSIDE = r'(?:[^"\\\x00-\x1F]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+'
BLANK = r"[ \t\r\n]*+"
VALUE = rf'(?=")((?:"{INSIDE}"{BLANK}:{BLANK})?+)(?:("){INSIDE}("))?+'
ALIKE = rf"(\{{[^{{}}\[\]]*+\}})(?:{BLANK},{BLANK}\1)++"
#: Reads what the parser of variants reads, and texts of any length.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxStringLen": str(2**31 - 1)}
#: Bytes of a shape that no variant holds; beyond them it is an error, whatever it says.
MOST = 1 << 27
MARKED = r"(?s)<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n"


@dataclass(frozen=True)
class Fields:
    """A flat layout: each role's text is in a field of its own, in this order."""

    roles: Sequence[tuple[str, str]]

    def paths(self) -> tuple[str, ...]:
        return ("OBJECT<" + ", ".join(sorted(name for _, name in self.roles)) + ">",)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in sorted({name for _, name in self.roles})])

    def turns(self, read: Column) -> Column:
        return F.array(
            *[
                F.struct(F.lit(role).alias("role"), F.coalesce(read[name], F.lit("")).alias("text"))
                for role, name in self.roles
            ]
        )


@dataclass(frozen=True)
class Messages:
    """A list of messages; `names` translates their roles."""

    list: str
    role: str
    text: str
    names: Mapping[str, str] = field(default_factory=dict)

    def paths(self) -> tuple[str, ...]:
        inside = ", ".join(sorted((self.role, self.text)))
        return (f"OBJECT<{self.list}: ARRAY<OBJECT<{inside}>>>", f"OBJECT<{self.list}: ARRAY<VOID>>")

    def schema(self) -> T.StructType:
        inside = T.StructType([T.StructField(name, T.StringType()) for name in (self.role, self.text)])
        return T.StructType([T.StructField(self.list, T.ArrayType(inside))])

    def turns(self, read: Column) -> Column:
        def turn(m: Column) -> Column:
            role = F.coalesce(m[self.role], F.lit(""))
            for given, canonical in self.names.items():
                role = F.when(m[self.role] == given, F.lit(canonical)).otherwise(role)
            return F.struct(role.alias("role"), F.coalesce(m[self.text], F.lit("")).alias("text"))

        return F.coalesce(F.transform(read[self.list], turn), F.array().cast(TURN))


#: Known layouts. A record of another fingerprint is kept, with no layout and no turns.
LAYOUTS: dict[str, Fields | Messages] = {
    "prompt": Fields((("user", "prompt"), ("assistant", "response"))),
    "instruction": Fields((("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    "messages": Messages("messages", "role", "content"),
    "conversations": Messages("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
}


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def field_paths(record: Column) -> Column:
    """The nested field names of a variant without the types of their scalars, names in order."""
    return F.regexp_replace(F.schema_of_variant(record), r": (?!ARRAY<|OBJECT<)\w+(\([0-9,]+\))?", "")


def shape(record: Column) -> Column:
    """JSON of the same field paths without the texts: values that are strings are empty, and of
    neighbours of one shape in a list there is one."""
    bare = F.regexp_replace(record, F.lit(VALUE), F.lit("$1$2$3"))
    return F.regexp_replace(bare, F.lit(ALIKE), F.lit("$1"))


def parsed(shape: Column) -> Column:
    """The variant of a shape, NULL if it is not JSON, of whatever size up to MOST."""
    return F.when(F.octet_length(shape) > MOST, F.parse_json(shape)).otherwise(F.try_parse_json(shape))


def canonical(records: DataFrame, record: str, layouts: Mapping[str, Fields | Messages] = LAYOUTS) -> DataFrame:
    """Adds `layout` and `turns` to rows with JSON in the column `record`.

    A NULL record, one that is not JSON, or one with undeclared fields has neither. NULL texts and
    roles of declared layouts are empty. The layout is chosen by the record without its texts; these
    are read as strings, which may be of any length. Columns called layout or turns are replaced, all
    others stay. A record whose text outside of strings is over MOST bytes is an error.
    """
    held, paths = unused(records, "_shape"), unused(records, "_paths")
    out = records.withColumn(held, shape(F.col(record)))
    out = out.withColumn(paths, fingerprint(field_paths(parsed(F.col(held)))))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURN)
    for name, mapping in layouts.items():
        known = reduce(or_, [F.col(paths) == fingerprint(F.lit(p)) for p in mapping.paths()])
        layout = F.when(known, F.lit(name)).otherwise(layout)
    out = out.withColumn("layout", layout)
    reads = {name: unused(records, f"_read_{k}") for k, name in enumerate(layouts)}
    out = out.withColumns(
        {
            reads[name]: F.when(F.col("layout") == name, F.from_json(F.col(record), mapping.schema(), STRICT))
            for name, mapping in layouts.items()
        }
    )
    for name, mapping in layouts.items():
        turns = F.when(F.col("layout") == name, mapping.turns(F.col(reads[name])).cast(TURN)).otherwise(turns)
    return out.withColumn("turns", turns).drop(held, paths, *reads.values())


def unused(rows: DataFrame, name: str) -> str:
    """A column name that the rows do not have."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def pattern(escaped: bool) -> str:
    """A control string after its first character's backslashes: any number, or one at least."""
    firsts = sorted({c[0] for c in CONTROL})
    arms = []
    for first in firsts:
        rests = "|".join(quoted(c[1:]) for c in CONTROL if c[0] == first)
        arms.append(f"(?<={quoted(first)}){{}}(?=\\\\*(?:{rests}))")
    slash = r"\\" if escaped else ""
    return "|".join(a.format(slash) for a in arms)


def quoted(text: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() else c for c in text)


def escape(text: Column) -> Column:
    """Puts one backslash after the first character of every control string, however many stand
    there already, so that none is left and `unescape` gets the text back."""
    return F.regexp_replace(text, F.lit(pattern(False)), F.lit("\\\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(pattern(True)), F.lit(""))


def segments(turns: Column, learn: str = "assistant") -> Column:
    """The formatted conversation as pieces in order, each with `loss`: whether it is learned from.
    Their concatenation is the formatted text."""

    def of(turn: Column) -> Column:
        head = F.concat(F.lit(OPEN), F.url_encode(turn["role"]), F.lit("\n"))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), (turn["role"] == learn).alias("loss")),
            F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
        )

    return F.flatten(F.transform(turns, of))


def formatted(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["text"]), "")


def learned(pieces: Column) -> Column:
    """The text under the loss mask, as it was before formatting."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")


def read_turns(text: Column) -> Column:
    """The turns of a formatted text."""
    roles = F.regexp_extract_all(text, F.lit(MARKED), F.lit(1))
    texts = F.regexp_extract_all(text, F.lit(MARKED), F.lit(2))
    return F.zip_with(
        roles,
        texts,
        lambda r, t: F.struct(F.url_decode(r).alias("role"), unescape(t).alias("text")),
    )


def format_records(records: DataFrame, record: str) -> DataFrame:
    """Adds layout, turns and `segments` to the rows, or replaces them; NULL segments where no layout is
    known."""
    return canonical(records, record).withColumn("segments", segments(F.col("turns")))
