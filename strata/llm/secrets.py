"""Secrets in texts, with DataFrame functions only: strong ones by their shape; weak ones only where
the parts of a credential, an identifier, a secret and an endpoint, come together."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

SPAN = "array<struct<start:bigint,kind:int,end:bigint,part:int>>"
#: Parts of a credential.
IDENTIFIER, SECRET, ENDPOINT = 1, 2, 3


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def assigned(names: str, value: str) -> str:
    """A name, perhaps in quotes, an equals sign or colon, and a value, its second group."""
    return f"""({either_case(names)})["']?\\x20*[:=]\\x20*["']?({value})"""


@dataclass(frozen=True)
class Kind:
    """What a kind of span looks like: a pattern, how many characters its group must have at least,
    and which part of a credential it can be (0: none).

    Spans are the matches of the pattern, leftmost first and apart; those whose group is too short,
    or that lack one of `needs`, are dropped, or with `short` the others. None may hold a line feed.
    A text has matches only if it holds one of `hints` in lower case and a match of `run`, both
    cheaper to look for in the many texts that have none.
    """

    pattern: str
    part: int
    least: int = 1
    group: int = 0
    short: bool = False
    needs: tuple[str, ...] = ()
    hints: tuple[str, ...] = ()
    run: str | None = None


def words(names: str) -> tuple[str, ...]:
    """The alternatives of names, with and without what is optional, a character or an underline."""
    out: list[str] = []
    for name in names.split("|"):
        out += {re.sub(r".\?", "", name), name.replace("?", "")}
    return tuple(out)


VALUE = "[A-Za-z0-9+/_.=-]+"
NAMES = "password|passwd|secret|token|api_?key"
IDS = "client_?id|key_?id|account|user_?name|user|login"
HOSTS = "hostname|host|server|endpoint"
SCHEMES = "https?|ftp|sftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp"
#: What a long run of letters and digits has.
RUN = "[A-Za-z0-9+/_-]{20}"
#: Always reported, in this order.
STRONG: dict[str, Kind] = {
    "assign": Kind(assigned(NAMES, VALUE), SECRET, 8, 2, hints=words(NAMES)),
    "access": Kind("AKIA[A-Z0-9]+", IDENTIFIER, 16, hints=("akia",)),
    "hex": Kind("[0-9a-f]{32,}", SECRET, 32, run=RUN),
}
#: Reported with their complements only. A short value is too common alone, and so are the others.
WEAK: dict[str, Kind] = {
    "identifier": Kind(assigned(IDS, "[A-Za-z0-9._@+-]+"), IDENTIFIER, 3, 2, hints=words(IDS)),
    "short": Kind(assigned(NAMES, VALUE), SECRET, 8, 2, short=True, hints=words(NAMES)),
    "key": Kind("[A-Za-z0-9+/_-]{20,}={0,2}", SECRET, 20, needs=("[A-Z]", "[a-z]", "[0-9]"), run=RUN),
    "endpoint": Kind(f"(?:{either_case(SCHEMES)})://[^\\x00-\\x20\"'<>]+", ENDPOINT, hints=("://",)),
    "host": Kind(assigned(HOSTS, "[A-Za-z0-9.-]+"), ENDPOINT, 3, 2, hints=words(HOSTS)),
}
#: Which parts must be near for a weak part to be told: all of one of these sets.
COMPLEMENTS: dict[int, tuple[tuple[int, ...], ...]] = {
    IDENTIFIER: ((SECRET,),),
    SECRET: ((IDENTIFIER,), (ENDPOINT,)),
    ENDPOINT: ((IDENTIFIER, SECRET),),
}
#: An empty line ends a scope.
SCOPE = r"\n[\x20\t\r]*\n"
#: Characters between parts of one credential at most.
REACH = 200
#: Steps of a running sum over a part of an array; a fold copies what it has, so it must stay short.
STEPS = 512
#: Rows a linked text is copied to, for its many documents to meet it in as many tasks.
COPIES = 16


def starts(sizes: str) -> Column:
    """The sums of the numbers before each in a column: running sums inside slices, over those of
    whole slices."""
    first = F.sequence(F.lit(1), F.size(sizes), F.lit(STEPS))
    slices = F.when(F.size(sizes) > 0, F.transform(first, lambda k: F.slice(sizes, k, STEPS)))

    def running(array: Column, first: Column) -> Column:
        return F.aggregate(array, F.array(first), lambda done, x: F.array_append(done, F.element_at(done, -1) + x))

    zero = F.lit(0).cast("bigint")
    totals = F.transform(slices, lambda s: F.aggregate(s, zero, lambda a, x: a + x))
    pairs = F.zip_with(slices, running(totals, zero), lambda s, at: F.struct(s.alias("s"), at.alias("first")))
    pairs = F.filter(pairs, lambda p: p["s"].isNotNull())
    sums = F.flatten(F.transform(pairs, lambda p: F.slice(running(p["s"], p["first"]), 1, F.size(p["s"]))))
    return F.coalesce(sums, F.array().cast("array<bigint>"))


def matches(text: Column, kind: Kind, hinted: Column) -> Column:
    """Of each match: the characters before it since the last, its own, those of its group, and
    whether all needs are in it."""
    pattern, group = kind.pattern, kind.group
    fine = lambda m: reduce(lambda a, n: a & m.rlike(n), kind.needs, F.lit(True))
    inside = lambda m: F.length(F.regexp_extract(m, pattern, group)) if group else F.length(m)
    found = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, m: F.struct(
            F.length(gap).cast("bigint").alias("gap"), F.length(m).cast("bigint").alias("size"),
            inside(m).alias("inside"), fine(m).alias("fine"),
        ),
    )
    # Behind the last match there is one more gap.
    none = F.array().cast("array<struct<gap:bigint,size:bigint,inside:int,fine:boolean>>")
    return F.when(hinted & text.rlike(pattern), F.filter(found, lambda m: m["size"].isNotNull())).otherwise(none)


def placed(found: str, at: str, number: int, kind: Kind) -> Column:
    """The spans among the matches in a column, by places in code points; a column has the sums of
    gaps and sizes before each."""
    pairs = F.zip_with(found, at, lambda m, at: F.struct(m.alias("m"), at.alias("at")))
    enough = lambda m: m["inside"] < kind.least if kind.short else m["inside"] >= kind.least
    kept = F.filter(pairs, lambda b: enough(b["m"]) & b["m"]["fine"])

    def span(b: Column) -> Column:
        start = b["at"] + b["m"]["gap"]
        return F.struct(
            start.alias("start"), F.lit(number).alias("kind"),
            (start + b["m"]["size"]).alias("end"), F.lit(kind.part).alias("part"),
        )

    return F.transform(kept, span)


def spans(docs: DataFrame, text: str, kinds: Mapping[str, Kind], columns: Mapping[str, str], first: int = 0) -> DataFrame:
    """Adds the spans of each kind in the column named for it; kinds are numbered from `first`.

    Each step is a column of its own, as a lambda would work out an expression for every element.
    """
    out = docs.withColumn("lower", F.lower(text))
    asked = {hint: F.col("lower").contains(hint) for v in kinds.values() for hint in v.hints}
    asked |= {v.run: F.col(text).rlike(v.run) for v in kinds.values() if v.run}
    known = {question: f"hint_{i}" for i, question in enumerate(asked)}
    out = out.withColumns({known[question]: answer for question, answer in asked.items()}).drop("lower")

    def hinted(kind: Kind) -> Column:
        some = reduce(lambda a, h: a | F.col(known[h]), kind.hints, F.lit(not kind.hints))
        return some & F.col(known[kind.run]) if kind.run else some

    found = out.withColumns({columns[k]: matches(F.col(text), v, hinted(v)) for k, v in kinds.items()})
    found = found.drop(*known.values())
    step = lambda m: m["gap"] + m["size"]
    found = found.withColumns({f"{c}_step": F.transform(c, step) for c in columns.values()})
    found = found.withColumns({f"{c}_at": starts(f"{c}_step") for c in columns.values()})
    found = found.withColumns(
        {columns[k]: placed(columns[k], f"{columns[k]}_at", first + i, v) for i, (k, v) in enumerate(kinds.items())}
    )
    return found.drop(*[f"{c}_{end}" for c in columns.values() for end in ("step", "at")])


def told(spans: Column, names: list[str]) -> Column:
    """Sorted spans as kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(n) for n in names])
    one = lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def has(spans: Column, *parts: int) -> Column:
    return reduce(lambda a, p: a & F.exists(spans, lambda s: s["part"] == p), parts, F.lit(True))


def complemented(present: Mapping[int, Column], part: Column) -> Column:
    """Whether one of the sets of parts that a weak part needs is there whole."""
    out = F.lit(False)
    for own, sets in COMPLEMENTS.items():
        any_of = reduce(
            lambda a, s: a | reduce(lambda b, p: b & present[p], s, F.lit(True)), sets, F.lit(False)
        )
        out = out | ((part == own) & any_of)
    return out


def link(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """(digest, linked): of each text the weak spans that have their complements within `reach`
    characters and no empty line between; rows are (digest, start, kind, end, part, weak), and a
    part 0 is the end of a scope.

    Scopes are numbered along each text. Spans then meet in bins of `reach` characters of their
    scope, each where it is and each weak one where its reach is. Spans of one kind do not overlap,
    so a bin holds a bounded number of them, however long or full of spans a text is.
    """
    order = Window.partitionBy("digest").orderBy("start", "part", "kind").rowsBetween(Window.unboundedPreceding, 0)
    scoped = parts.withColumn("scope", F.count_if(F.col("part") == 0).over(order)).where("part <> 0")
    scoped = written(scoped, "parts")
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / reach), F.floor(b / reach))).alias("bin")
    weak = scoped.where("weak").select(
        "digest", "scope", "start", "kind", "end", "part", bins(F.col("start") - reach, F.col("end") + reach)
    )
    near = scoped.select(
        "digest", "scope", F.col("start").alias("o_start"), F.col("end").alias("o_end"), F.col("part").alias("o_part"),
        (~F.col("weak")).alias("strong"), bins(F.col("start"), F.col("end") - 1),
    )
    apart = F.greatest(F.col("start"), F.col("o_start")) - F.least(F.col("end"), F.col("o_end"))
    met = weak.join(near, ["digest", "scope", "bin"]).where(apart <= reach)
    seen = met.groupBy("digest", "start", "kind", "end", "part").agg(
        F.bool_or(F.col("strong") & (apart < 0)).alias("covered"),
        *[F.bool_or(F.col("o_part") == p).alias(f"has_{p}") for p in COMPLEMENTS],
    )
    linked = seen.where(~F.col("covered") & complemented({p: F.col(f"has_{p}") for p in COMPLEMENTS}, F.col("part")))
    return linked.groupBy("digest").agg(F.collect_list(F.struct("start", "kind", "end", "part")).alias("linked"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """Of each row its key, `base`, the strong spans, and `spans`, these and the linked weak ones, as
    sorted arrays of (start, kind, end, part): code points, the end exclusive, kinds numbered as in
    STRONG and then WEAK.

    A NULL text is empty and an empty one has no spans. Rows that repeat, and keys that repeat or are
    NULL, are rows each; other columns play no part. A weak span that overlaps a strong one is not
    told, as that tells it already, but a strong one is a part like others.
    """
    strong, weak = {k: f"strong_{k}" for k in STRONG}, {k: f"weak_{k}" for k in WEAK}
    given = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = spans(given, "text", STRONG, strong)
    found = found.withColumn("base", F.sort_array(F.concat(*strong.values())))
    found = spans(found, "text", WEAK, weak, len(STRONG))
    found = found.withColumn("weak", F.concat(*weak.values()))
    every = F.concat("base", "weak")
    # Only a text that has a weak part and, anywhere, its complements is looked at further.
    worth = reduce(
        lambda a, own: a | (has(F.col("weak"), own) & reduce(lambda b, s: b | has(every, *s), COMPLEMENTS[own], F.lit(False))),
        COMPLEMENTS, F.lit(False),
    )
    found = found.withColumn("digest", F.when(worth, F.sha2(F.col("text").cast("binary"), 256)))
    found = found.withColumn("worth", F.when(F.col("digest").isNotNull(), F.col("text")).otherwise(""))
    found = spans(found, "worth", {"breaks": Kind(SCOPE, 0)}, {"breaks": "breaks"}, -1)
    found = written(found.select("key", "base", "weak", "digest", "breaks"), "spans")
    # One row of each text; copies of a text have the same spans.
    rows = found.where("digest IS NOT NULL").select(
        "digest",
        F.explode(
            F.concat(
                F.transform(F.concat("base", "breaks"), lambda s: F.struct(s.alias("span"), F.lit(False).alias("weak"))),
                F.transform("weak", lambda s: F.struct(s.alias("span"), F.lit(True).alias("weak"))),
            )
        ).alias("row"),
    )
    linked = link(rows.select("digest", "row.span.*", "row.weak").distinct(), reach)
    copies = linked.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    asking = found.where("digest IS NOT NULL").withColumn("copy", F.pmod(F.xxhash64("key"), F.lit(COPIES)).cast("int"))
    answered = asking.join(copies, ["digest", "copy"], "left").select("key", "base", "linked")
    alone = found.where("digest IS NULL").select("key", "base", F.lit(None).cast(SPAN).alias("linked"))
    none = F.array().cast(SPAN)
    kind = docs.schema[key].dataType
    return answered.unionByName(alone).select(
        F.col("key").cast(kind).alias(key), "base", F.sort_array(F.concat("base", F.coalesce("linked", none))).alias("spans")
    )


def count_of(spans: Column, name: str) -> Column:
    number = [*STRONG, *WEAK].index(name)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")
