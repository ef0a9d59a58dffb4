"""Phrase collocations: a weighted de Bruijn graph whose edges are the longest grams and whose nodes
are what neighbouring edges share; counts of shorter grams are flows through its nodes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_batches, written

#: What ends a piece; a word that no text has, since it ends pieces.
MARKS, END = r"[.,;:!?\x0A-\x0D]+", "."
#: Bytes of text whose graph a task holds at a time, and whose grams, spread over all, a bucket holds.
TOGETHER, PER_BUCKET = 4 << 20, 5 << 20


@dataclass(frozen=True)
class Params:
    """Phrases of 2 to `longest` words that occur `least` times or more; a phrase is dropped if a
    longer one that holds it has `percent` of its occurrences."""

    longest: int = 3
    least: int = 10
    percent: int = 50


def graph_of(langs: pa.Array, texts: pa.Array, longest: int, buckets: int = 1) -> pa.RecordBatch:
    """Rows (bucket, grams, f) of the texts' grams of 1 to `longest` words, each as `lang`, a tab and
    the words, and of each language's number of words, as `lang` and a tab; a row for each bucket, its
    grams on a line each and their counts as longs.

    Only the longest grams are counted. A shorter one occurs as often as edges leave its node, and
    once more for each piece that ends with it.
    """
    marked = pc.replace_substring_regex(pc.ascii_lower(texts), MARKS, f" {END} ")
    # A mark before each text as well, so that no gram goes from one text to the next.
    split = pc.ascii_split_whitespace(pc.binary_join_element_wise(END, marked, " "))
    coded = split.flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy()
    kinds = langs.dictionary_encode()
    lang = np.repeat(kinds.indices.to_numpy(), np.diff(split.offsets.to_numpy()))
    if (empty := words.index("").as_py()) >= 0:
        codes, lang = codes[codes != empty], lang[codes != empty]
    ends, size = words.index(END).as_py(), len(words)
    inside = codes != ends
    totals = np.bincount(lang[inside], minlength=len(kinds.dictionary))
    hashes = hash_array(words.to_numpy(zero_copy_only=False), categorize=False)
    own_hash = hash_array(kinds.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    number = np.where(inside, lang * np.int64(size) + codes, -1)
    del marked, split, coded, lang, inside
    # Per length the gram that starts at each place, or -1, and of each gram its string and hash.
    at, strings, hashed = [], [kinds.dictionary], [own_hash]
    for k in range(longest):
        if k:
            after = np.full(len(codes), ends, codes.dtype)
            after[:-k] = codes[k:]
            number = np.where((at[-1] >= 0) & (after != ends), at[-1] * np.int64(size) + after, -1)
        keys, own = np.unique(number, return_inverse=True)
        skip = int(len(keys) > 0 and keys[0] < 0)
        first, last = np.divmod(keys[skip:], size)
        head, word = strings[-1].take(pa.array(first)), words.take(pa.array(last))
        strings.append(pc.binary_join_element_wise(head, word, " " if k else "\t"))
        hashed.append(hashed[-1][first] * np.uint64(0x9E3779B97F4A7C15) + hashes[last])
        at.append((own - skip).astype(np.int32))
    flow = np.bincount(at[-1][at[-1] >= 0], minlength=len(strings[-1]))
    flows = [flow]
    for k in range(longest - 2, -1, -1):
        here, longer = at[k], at[k + 1]
        # Edges leave the node of their first words; pieces end at places that no longer gram starts from.
        node = np.zeros(len(flow), np.int64)
        node[longer[longer >= 0]] = here[longer >= 0]
        left = np.bincount(node, flow, len(strings[k + 1])).astype(np.int64)
        flow = left + np.bincount(here[(here >= 0) & (longer < 0)], minlength=len(left))
        flows.append(flow)
    del at
    strings[0] = pc.binary_join_element_wise(kinds.dictionary, "", "\t")
    f = np.concatenate([totals, *flows[::-1]]).astype("<i8")
    bucket = np.concatenate(hashed)
    bucket = ((bucket ^ bucket >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    lines = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.concat_arrays(strings).take(pa.array(order)))
    f = f[order]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[order][edges[:-1]]),
            pc.binary_join(lines, "\n"),
            pa.array([f[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
        ],
        ["bucket", "grams", "f"],
    )


def merged(blocks: pa.Table, least: int) -> pa.Table:
    """(lang, gram, k, f) of the grams of a bucket that occur often enough, and the languages' numbers
    of words."""
    grams = pc.split_pattern(blocks["grams"], "\n").combine_chunks().flatten()
    f = np.frombuffer(b"".join(blocks["f"].to_pylist()), "<i8")
    summed = pa.table({"gram": grams, "f": f}).group_by("gram").aggregate([("f", "sum")])
    total = pc.ends_with(summed["gram"], "\t")
    kept = summed.filter(pc.or_(total, pc.greater_equal(summed["f_sum"], least)))
    # A language may hold tabs, a gram does not.
    cut = [gram.rpartition("\t") for gram in kept["gram"].to_pylist()]
    k = [gram.count(" ") + 1 if gram else 0 for _, _, gram in cut]
    columns = [pa.array([c[0] for c in cut], pa.string()), pa.array([c[2] for c in cut], pa.string()), pa.array(k, pa.int32())]
    return pa.table([*columns, kept["f_sum"]], ["lang", "gram", "k", "f"])


def counts(docs: DataFrame, params: Params, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, gram, k, f) of the grams of k words, 1 to the longest, that occur often enough, and with
    k 0 each language's number of words; written once.

    Flows of parts of the corpus add up, so the graph of some texts at a time is all that a task holds,
    and a gram of it, however frequent, is one line that is shuffled. Lines travel by the bucket of
    their hash; there are as many buckets as the texts' size asks for, each of bounded size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            lengths = np.cumsum(pc.binary_length(batch.column(1)).to_numpy())
            start = 0
            while start < batch.num_rows:
                before = lengths[start - 1] if start else 0
                end = int(np.searchsorted(lengths, before + TOGETHER - size)) + 1
                held.append(batch.slice(start, end - start))
                size += int(lengths[min(end, batch.num_rows) - 1] - before)
                start = end
                if size >= TOGETHER:
                    yield graph(held)
                    held, size = [], 0
        if held:
            yield graph(held)

    def graph(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        columns = [table[c].combine_chunks() for c in ("lang", "text")]
        return graph_of(*columns, params.longest, buckets)

    given = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    given = given.where("text <> ''")
    buckets = 1 + (given.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PER_BUCKET
    blocks = map_batches(given, run, "bucket int, grams string, f binary")
    kept = blocks.groupBy("bucket").applyInArrow(
        lambda t: merged(t, params.least), "lang string, gram string, k int, f long"
    )
    return written(kept, "grams")


def part(words: Column) -> Column:
    """The first words of `gram`, the last ones if negative."""
    return F.call_function("substring_index", F.col("gram"), F.lit(" "), words)


def neighbours(edges: DataFrame) -> DataFrame:
    """Of each node (lang, gram) that edges (lang, gram, k, f) leave or reach: how many they are
    (n_out, n_in), the largest f (most_out, most_in), and the edge itself (next, before)."""
    sides = edges.select(
        "lang",
        F.explode(
            F.array(
                F.struct(part(F.col("k") - 1).alias("gram"), F.lit(True).alias("out"), F.col("gram").alias("edge"), "f"),
                F.struct(part(1 - F.col("k")).alias("gram"), F.lit(False).alias("out"), F.col("gram").alias("edge"), "f"),
            )
        ).alias("side"),
    ).select("lang", "side.*")
    out = F.col("out")
    return sides.groupBy("lang", "gram").agg(
        F.count_if(out).alias("n_out"),
        F.count_if(~out).alias("n_in"),
        F.max(F.when(out, F.col("f"))).alias("most_out"),
        F.max(F.when(~out, F.col("f"))).alias("most_in"),
        F.max(F.when(out, F.col("edge"))).alias("next"),
        F.max(F.when(~out, F.col("edge"))).alias("before"),
    )


def compact(found: DataFrame, longest: int) -> DataFrame:
    """(lang, edge, path, place): each edge, the first edge of its unary path, and its place there from 0.

    A path goes on through a node that one edge reaches and one leaves, both as often as the node
    occurs; so all its edges, and the shorter grams inside it, occur equally often. It never closes to
    a circle, as pieces begin and end. Pointers of the edges double their length in each round, as many
    rounds as the longest path needs; what has reached its head leaves.
    """
    edges = found.where(F.col("k") == longest)
    inner = (
        neighbours(edges)
        .where("n_in = 1 AND n_out = 1 AND most_in = most_out")
        .join(found.where(F.col("k") == longest - 1).select("lang", "gram", "f"), ["lang", "gram"])
        .where("f = most_in")
        .select("lang", F.col("next").alias("edge"), F.col("before").alias("prev"))
    )
    # Those whose pointer is at the head of their path are done, the others are looked up on.
    inner = written(inner, "inner")
    done: list[DataFrame] = []
    pointers = inner.withColumn("steps", F.lit(1).cast("long"))
    while not pointers.isEmpty():
        known = reduce(DataFrame.unionByName, done, pointers)
        further = known.select(
            "lang", F.col("edge").alias("prev"), F.col("prev").alias("further"), F.col("steps").alias("more")
        )
        stepped = written(pointers.join(further, ["lang", "prev"], "left"), "stepped")
        done.append(stepped.where("further IS NULL").select("lang", "edge", "prev", "steps"))
        pointers = stepped.where("further IS NOT NULL").select(
            "lang", "edge", F.col("further").alias("prev"), (F.col("steps") + F.col("more")).alias("steps")
        )
    placed = [d.select("lang", "edge", F.col("prev").alias("path"), F.col("steps").alias("place")) for d in done]
    heads = edges.select("lang", F.col("gram").alias("edge")).join(inner, ["lang", "edge"], "left_anti")
    heads = heads.select("lang", "edge", F.col("edge").alias("path"), F.lit(0).cast("long").alias("place"))
    return reduce(DataFrame.unionByName, placed, heads)


def paths(found: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, n_words, f) of the unary paths of the graph: whole passages that come again and
    again, each no longer than the longest document, with how often."""
    edges = found.where(F.col("k") == longest).select("lang", F.col("gram").alias("edge"), "f")
    placed = compact(found, longest).join(edges, ["lang", "edge"])
    last = F.substring_index("edge", " ", -1)
    word = F.when(F.col("place") == 0, F.col("edge")).otherwise(last)
    return placed.groupBy("lang", "path").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", word.alias("w")))), lambda x: x["w"]), " ").alias("phrase"),
        (F.count("*") + longest - 1).alias("n_words"),
        F.max("f").alias("f"),
    ).drop("path")


def candidates(found: DataFrame, params: Params) -> DataFrame:
    """(lang, gram, k, f) of phrases that are not dropped for a longer one.

    A longer phrase that holds a gram of k words and is frequent enough to drop it holds one of k + 1
    words that is, too; these are the edges at the gram's node. A node inside a unary path always goes.
    """
    phrases = found.where(F.col("k") >= 2)
    around = neighbours(phrases.where(F.col("k") >= 3)).select(
        "lang", "gram", F.greatest("most_in", "most_out").alias("longer")
    )
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    kept = phrases.join(around, ["lang", "gram"], "left")
    return kept.where(F.col("longer").isNull() | (100 * wide("longer") < params.percent * wide("f"))).drop("longer")


def mine(docs: DataFrame, params: Params = Params(), most: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """The `most` phrases of each language that hold together best: lang, rank, phrase, a, l, r, n,
    score, and `path_words`, the length of the unary path that a phrase of the longest size lies on.

    A phrase occurs `a` times; cut after k words its parts occur l and r times; the cut of the lowest
    floor(10^6 a^2 / (l r)) counts, ties to the smallest k. n is the language's number of words. A
    NULL language is `und`, a NULL text empty; other columns play no part, rows that repeat count
    each, and a text without words has no phrases.
    """
    found = counts(docs, params, lang, text)
    every = found.where(F.col("k") > 0).select("lang", F.col("gram").alias("own"), F.col("f").alias("own_f"))
    cuts = candidates(found, params).select(
        "lang", "gram", "k", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    )
    cuts = cuts.withColumns({"left": part(F.col("cut")), "right": part(F.col("cut") - F.col("k"))})
    cuts = cuts.join(every.withColumnsRenamed({"own": "left", "own_f": "l"}), ["lang", "left"])
    cuts = cuts.join(every.withColumnsRenamed({"own": "right", "own_f": "r"}), ["lang", "right"])
    # Counts below 10^16 make products below 10^38, exact as decimals.
    exact = lambda c: F.col(c).cast("decimal(16,0)")
    cuts = cuts.withColumns({"aa": F.lit(1000000).cast("decimal(7,0)") * (exact("a") * exact("a")), "lr": exact("l") * exact("r")})
    cuts = cuts.withColumn("score", F.expr("aa div lr"))
    best = cuts.groupBy("lang", "gram", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    # A language's phrases are ranked in parts first, so that no task has all of them.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = (F.desc("score"), F.desc("a"), "phrase")
    first = best.select("lang", F.col("gram").alias("phrase"), "a", "best.l", "best.r", "best.score")
    for own in (("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))), ("lang",)):
        rank = F.row_number().over(Window.partitionBy(*own).orderBy(*order))
        first = first.withColumn("rank", rank).where(F.col("rank") <= most)
    total = found.where("k = 0").select("lang", F.col("f").alias("n"))
    placed = compact(found, params.longest)
    sizes = placed.groupBy("lang", "path").agg((F.count("*") + params.longest - 1).alias("path_words"))
    on_path = placed.join(sizes, ["lang", "path"]).select("lang", F.col("edge").alias("phrase"), "path_words")
    return (
        first.join(total, "lang")
        .join(on_path, ["lang", "phrase"], "left")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "path_words")
    )
