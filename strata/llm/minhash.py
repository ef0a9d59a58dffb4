"""Near-duplicates by b-bit MinHash: candidates from bands of minima, a collision-corrected estimate
from packed low bits, then the exact test on whole shingle sets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, remembered, written
from strata.llm.components import components

MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Params:
    words: int = 5
    #: Documents are linked if 100 * shared >= percent * union, in shingles.
    percent: int = 80
    hashes: int = 128
    bits: int = 4
    #: The share of links at the very threshold that the bands may miss.
    missed: float = 1e-6
    #: Standard deviations that an estimate may fall short of the threshold.
    slack: float = 5.0
    #: Members of a bucket that are compared in one go.
    block: int = 512
    seed: int = 11

    def rows(self) -> int:
        """Minima for each band: the most that keep to `missed`."""
        t = self.percent / 100
        fits = [r for r in range(1, 17) if (1 - t**r) ** (self.hashes // r) <= self.missed]
        return max(fits, default=1)

    def most_unequal(self) -> int:
        """Unequal low bits that an estimate at the threshold, less the slack, allows."""
        c, t = 2.0**-self.bits, self.percent / 100
        equal = t + (1 - t) * c
        return math.ceil(self.hashes * (1 - equal) + self.slack * math.sqrt(self.hashes * equal * (1 - equal)))


def similarity(unequal: Column, params: Params) -> Column:
    """The estimate: the share of equal low bits, less what chance gives."""
    c = 2.0**-params.bits
    return ((1 - unequal / params.hashes) - c) / (1 - c)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct hashed shingles, ascending: A-Z in lower case, words between ASCII white space;
    a shorter text is one shingle, a text without words has none."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    known = remembered("minhash", WordHashes)
    hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    n = min(words, len(hashes))
    rolling = np.full(len(hashes) - n + 1, n, np.uint64)
    for k in range(n):
        rolling = (rolling ^ hashes[k : len(hashes) - n + 1 + k]) * MIX
        rolling ^= rolling >> np.uint64(29)
    return np.unique(rolling * STEP)


def multipliers(params: Params) -> np.ndarray:
    rng = np.random.default_rng(params.seed)
    return rng.integers(0, 1 << 63, params.hashes, np.uint64) * np.uint64(2) + np.uint64(1)


def minima(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """For each (not empty) set the least product with each factor, modulo 2**64."""
    out = np.empty((len(sets), len(factors)), np.uint64)
    start = 0
    while start < len(sets):
        end, total = start, 0
        while end < len(sets) and (end == start or total + len(sets[end]) <= 32_768):
            total += len(sets[end])
            end += 1
        flat = np.concatenate(sets[start:end])
        at = np.cumsum([0, *(len(s) for s in sets[start : end - 1])])
        product = np.empty_like(flat)
        for k, factor in enumerate(factors):
            np.multiply(flat, factor, out=product)
            out[start:end, k] = np.minimum.reduceat(product, at)
        start = end
    return out


def packed(least: np.ndarray, bits: int) -> np.ndarray:
    """The low bits of the minima's upper halves, a plane of bits after the other, 64 to a word."""
    low = (least >> np.uint64(32)).astype(np.uint8)
    planes = [np.packbits((low >> b) & 1, axis=1).view("<u8") for b in range(bits)]
    return np.concatenate(planes, axis=1).view(np.int64)


def band_keys(least: np.ndarray, rows: int) -> np.ndarray:
    bands = least.shape[1] // rows
    with np.errstate(over="ignore"):
        key = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * STEP, (len(least), 1))
        for k in range(rows):
            key = (key ^ least[:, k : bands * rows : rows]) * MIX
            key ^= key >> np.uint64(31)
    return key.view(np.int64)


def sketch(docs: DataFrame, params: Params, key: str, text: str) -> DataFrame:
    """For each document: key, size of its set, fingerprint of the set, packed signature, band keys."""
    factors, rows = multipliers(params), params.rows()
    kind = docs.schema[key].dataType.simpleString()
    longs = pa.list_(pa.int64())

    def lists(found: np.ndarray, at: np.ndarray, n: int) -> pa.Array:
        """found's rows at the places `at` of n, NULL elsewhere."""
        out: list = [None] * n
        for place, row in zip(at, found, strict=True):
            out[place] = row
        return pa.array(out, longs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (batch.slice(k, 500) for k in range(0, batch.num_rows, 500)):
                sets = [shingles(t.as_py(), params.words) for t in piece.column(1)]
                at = np.flatnonzero([len(s) for s in sets])
                full = [sets[i] for i in at]
                least = minima(full, factors)
                marks: list = [None] * len(sets)
                for i in at:
                    marks[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(marks, pa.binary()),
                        lists(packed(least, params.bits), at, len(sets)),
                        lists(band_keys(least, rows), at, len(sets)),
                    ],
                    ["key", "size", "mark", "signature", "bands"],
                )

    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_batches(given, run, f"key {kind}, size long, mark binary, signature array<long>, bands array<long>")


def unequal(a: Column, b: Column, params: Params) -> Column:
    """Hashes whose low bits differ, by bit counts over the planes."""
    words = params.hashes // 64
    per_word = [
        reduce(lambda x, y: x.bitwiseOR(y), [a[p * words + w].bitwiseXOR(b[p * words + w]) for p in range(params.bits)])
        for w in range(words)
    ]
    return reduce(lambda x, y: x + y, [F.bit_count(x) for x in per_word])


def sizes_allow(a: Column, b: Column, params: Params) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * params.percent


#: Keys that a broadcast may hold (8 bytes each, and as much again for its hash table).
FEW_KEYS = 2_000_000


def only(docs: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The documents with (or, by `left_anti`, without) one of the written distinct `keys`: few keys
    go to the documents, so that their texts stay where they are; many meet them by a shuffle."""
    few = keys.count() <= FEW_KEYS
    return docs.join(F.broadcast(keys) if few else keys, keys.columns[0], how)


def shingle_sets(keys: DataFrame, docs: DataFrame, params: Params, key: str, text: str) -> DataFrame:
    """(key, set): the whole shingle sets of the documents with the distinct `keys` (key)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (batch.slice(k, 500) for k in range(0, batch.num_rows, 500)):
                found = [shingles(t.as_py(), params.words).view(np.int64) for t in piece.column(1)]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found, pa.list_(pa.int64()))], ["key", "set"])

    given = only(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), written(keys, "keys"))
    return map_batches(given, run, f"key {kind}, set array<long>")


def confirm(pairs: DataFrame, docs: DataFrame, params: Params, key: str, text: str) -> DataFrame:
    """Of the pairs (a, b) those whose whole shingle sets pass the threshold."""
    involved = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    sets = shingle_sets(involved, docs, params, key, text)
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("x")), "a").join(
        sets.select(F.col("key").alias("b"), F.col("set").alias("y")), "b"
    )
    shared = F.size(F.array_intersect("x", "y"))
    return (
        both.select("a", "b", shared.alias("shared"), (F.size("x") + F.size("y") - shared).alias("joint"))
        .where(F.col("shared") * 100 >= F.col("joint") * params.percent)
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document: key, n_shingles, component_id, kept.

    component_id is the smallest key reachable over links, kept tells whether it is the document's
    own. A document without words (NULL or blank text) is linked with nothing. A row without a key
    is kept and belongs to no component. Each row has the component of its own text, also if its
    key repeats.

    Equal sets are one class from the start. In each bucket of a band, every class is tested
    against the bucket's smallest one, which is linear in the bucket. Classes that are not joined by
    that are compared within their buckets by signature, in blocks; what may be linked forms groups,
    and in these the whole sets are compared, again in blocks. Each block gives away only the links
    that join what was apart, so that nothing grows with the square of a group but the comparisons
    inside a block, and no link between components is lost.
    """
    drawn = written(sketch(docs, params, key, text), "sketch")
    classes = written(
        drawn.where("size > 0 AND key IS NOT NULL").groupBy("mark").agg(F.min("key").alias("rep")), "classes"
    )
    reps = drawn.join(classes, "mark").where("key = rep").select("rep", "size", "signature", "bands")
    reps = written(reps, "representatives")

    buckets = reps.select(F.explode("bands").alias("bucket"), "rep")
    hubs = buckets.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).where("hub < top")
    members = written(buckets.join(hubs.drop("top"), "bucket"), "buckets")

    stars = members.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    signs = reps.select("rep", "size", "signature")
    likely = (
        stars.join(signs.toDF("a", "n", "s"), "a")
        .join(signs.toDF("b", "m", "t"), "b")
        .where(sizes_allow(F.col("n"), F.col("m"), params))
        .where(unequal(F.col("s"), F.col("t"), params) <= params.most_unequal())
        .select("a", "b")
        .distinct()
    )
    links = written(confirm(written(likely, "likely"), docs, params, key, text), "links")

    # A name that linked classes share: the smallest class that one is known to be linked with.
    names = written(links.groupBy(F.col("b").alias("named")).agg(F.min("a").alias("name")), "names")
    name = F.coalesce("name", "rep").alias("name")
    kind = reps.schema["rep"].dataType.simpleString()
    dealt = deal(members.join(names, members.rep == names.named, "left").select(F.col("bucket").alias("group"), "rep", name), params)
    maybe = compared(dealt.join(signs, "rep"), by_signature(params), kind)
    groups = components(maybe)
    groups = groups.unionAll(groups.select(F.col("root").alias("node"), "root").distinct())
    groups = written(groups.select(F.col("root").alias("group"), F.col("node").alias("rep")), "groups")
    sets = shingle_sets(groups.select(F.col("rep").alias("key")), docs, params, key, text)
    dealt = deal(groups.join(names, groups.rep == names.named, "left").select("group", "rep", name), params)
    more = compared(dealt.join(sets.withColumnRenamed("key", "rep"), "rep"), by_sets(params), kind)
    roots = components(links.unionAll(more))

    own = classes.join(roots, classes.rep == roots.node, "left").select(
        "mark", F.coalesce("root", "rep").alias("component")
    )
    found = drawn.select("key", "size", "mark").join(own, "mark", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return found.select(
        F.col("key").alias(key),
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("key").isNull() | (F.col("key") == component)).alias("kept"),
    )


def deal(members: DataFrame, params: Params) -> DataFrame:
    """The members (group, rep, name) of each group that holds several names, in pairs of blocks
    (group, i, j): such that any two of different names meet, and of the most frequent name, which
    may have most of the members, a member only meets those of other names."""
    members = written(members, "members")
    parts = members.groupBy("group", "name").agg(F.count("*").alias("n"))
    mixed = (
        parts.groupBy("group")
        .agg(
            F.max_by("name", F.struct("n", "name")).alias("main"),
            F.sum("n").alias("all"),
            F.max("n").alias("most"),
            F.count("*").alias("parts"),
        )
        .where("parts > 1")
        .drop("parts")
    )
    block = F.lit(params.block)
    small = F.col("all") <= block
    stray = F.col("name") != F.col("main")
    place = F.when(stray, F.pmod(F.xxhash64("rep"), F.col("rest"))).otherwise(
        F.col("rest") + F.pmod(F.xxhash64("rep"), F.col("mains"))
    )
    until = F.when(stray, F.col("rest") + F.col("mains") - 1).otherwise(F.col("rest") - 1)
    numbered = (
        members.join(mixed, "group")
        .withColumns({"rest": F.ceil((F.col("all") - F.col("most")) / block), "mains": F.ceil(F.col("most") / block)})
        .withColumns({"place": F.when(small, F.lit(0)).otherwise(place), "until": F.when(small, F.lit(0)).otherwise(until)})
    )
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("until").cast("long")))
    return numbered.select("group", "rep", "name", F.col("place").cast("long").alias("place"), others.alias("other")).select(
        "group", "rep", "name", "place", F.least("place", "other").alias("i"), F.greatest("place", "other").alias("j")
    )


def compared(dealt: DataFrame, linked: Callable, kind: str) -> DataFrame:
    """(a, b) from each pair of blocks (group, i, j): a link for each two names or members that the
    linked pairs join, as `linked` finds them, and no more."""
    block = ["group", "i", "j"]
    in_order = dealt.repartition(*block).sortWithinPartitions(*block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for table in then_none(batches):
            if table is not None:
                held = table if held is None else pa.concat_tables([held, table])
            if held is None or not held.num_rows:
                continue
            keys = [held[c].to_numpy() for c in block]
            starts = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
            ends = [*starts[1:], held.num_rows]
            done = len(starts) if table is None else len(starts) - 1
            found: list[tuple] = []
            for s, e in zip(starts[:done], ends[:done], strict=True):
                found += linked(held.slice(s, e - s))
            held = None if table is None else held.slice(starts[-1])
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return map_batches(in_order, run, f"a {kind}, b {kind}")


def then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table | None]:
    """The batches as tables, then None."""
    for batch in batches:
        yield pa.Table.from_batches([batch])
    yield None


def sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of the rows of the first and the second block; whether both are the same."""
    place, i, j = rows["place"].to_numpy(), rows["i"][0].as_py(), rows["j"][0].as_py()
    return np.flatnonzero(place == i), np.flatnonzero(place == j), i == j


def join_up(k: int, others: np.ndarray, root: np.ndarray, rep: np.ndarray) -> Iterator[tuple]:
    """Links of member k with one of each root among `others` that is not its own; they are joined."""
    apart = others[root[others] != root[k]]
    if len(apart):
        roots, first = np.unique(root[apart], return_index=True)
        yield from ((rep[k], rep[t]) for t in apart[first])
        root[np.isin(root, roots)] = root[k]


def by_signature(params: Params) -> Callable[[pa.Table], list[tuple]]:
    """Finds pairs of different names whose sizes and signatures allow a link, and gives away what
    holds together the members of such pairs."""
    words, most = params.hashes // 64, params.most_unequal()

    def linked(rows: pa.Table) -> list[tuple]:
        rep, name, size = (rows[c].to_numpy() for c in ("rep", "name", "size"))
        signs = rows["signature"].combine_chunks().flatten().to_numpy().view(np.uint64)
        planes = signs.reshape(len(rep), params.bits, words)
        left, right, same = sides(rows)
        root, found = np.arange(len(rep)), []
        for k in left:
            to = right[right > k] if same else right
            to = to[(name[to] != name[k]) & (root[to] != root[k])]
            to = to[np.minimum(size[to], size[k]) * 100 >= np.maximum(size[to], size[k]) * params.percent]
            if len(to):
                differ = np.bitwise_or.reduce(planes[to] ^ planes[k], axis=1)
                found += join_up(k, to[np.bitwise_count(differ).sum(axis=1) <= most], root, rep)
        return found

    return linked


def by_sets(params: Params) -> Callable[[pa.Table], list[tuple]]:
    """Finds links by the whole sets: shared shingles of all pairs at once, as a product of 0/1
    matrices, some thousand shingles at a time."""
    columns = 4096

    def linked(rows: pa.Table) -> list[tuple]:
        rep = rows["rep"].to_numpy()
        lists = rows["set"].combine_chunks()
        size = lists.value_lengths().to_numpy().astype(np.int64)
        flat, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(rep)), size)
        _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
        several = count[column] > 1
        column, owner = (np.cumsum(count > 1) - 1)[column[several]], owner[several]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        left, right, same = sides(rows)
        shared = np.zeros((len(left), len(right)), np.float32)
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
            s, e = np.searchsorted(column, (start, start + columns))
            has = np.zeros((len(rep), columns), np.float32)
            has[owner[s:e], column[s:e] - start] = 1
            shared += has[left] @ has[right].T
        joint = size[left][:, None] + size[right][None, :] - shared
        enough = shared * 100 >= joint * params.percent
        root = np.unique(rows["name"].to_numpy(), return_inverse=True)[1]
        found: list[tuple] = []
        for at, k in enumerate(left):
            to = right[enough[at]]
            found += join_up(k, to[to > k] if same else to, root, rep)
        return found

    return linked


def keep(docs: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, all columns; of rows that repeat a key and its text, one.
    Documents without a key stay. If a key has different texts, each is a document of its own."""
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    keyed = docs.where(F.col(key).isNotNull())
    by_key = keyed.select(F.col(key).alias("key"), digest.alias("digest")).groupBy("key")
    if by_key.agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a < b").isEmpty():
        return keep_keys(docs, params, key, text)
    # Numbers in the order of the keys stand for pairs of key and text.
    nodes = keyed.select(F.col(key).alias("_key"), digest.alias("_digest")).distinct().orderBy("_key", "_digest")
    nodes = written(nodes.select("*", F.monotonically_increasing_id().alias("_node")), "nodes")
    named = docs.join(nodes, (docs[key] == nodes["_key"]) & (digest == nodes["_digest"]), "left")
    named = written(named.select(*[docs[c] for c in docs.columns], "_node"), "named")
    return keep_keys(named, params, "_node", text).select(*docs.columns)


def keep_keys(docs: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`keep` for keys that have one text each."""
    found = written(near_duplicates(docs, params, key, text).select(F.col(key).alias(key), "kept"), "kept")
    dropped = written(found.where("NOT kept").select(key).distinct(), "dropped")
    repeated = found.where(F.col("kept") & F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key)
    repeated = written(repeated, "repeated")
    left = only(docs, dropped, "left_anti")
    once, several = only(left, repeated, "left_anti"), only(left, repeated)
    return once.unionByName(several.dropDuplicates([key])).select(*docs.columns)
