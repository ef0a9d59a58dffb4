"""SentencePiece encoding as a relational lattice, and decoding.

Texts are cut into words where no piece can cross. The distinct words of all texts get a lattice:
their substrings of bounded length are joined to the piece table, the edges grouped by bucket of
words, and the best paths of a bucket found together. Texts are then put together from the paths of their words.

Words travel once, packed by chunk of text and hash bucket; from there on numbers stand for them.
Tables that are met by the same key again are bucketed by it, so that they need no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import bucketed, map_batches, written
from strata.session import INITIAL_PARTITIONS, session_conf

SPACE = "▁"
#: How far an unknown character's score lies below that of any piece (fixed value of the format).
UNKNOWN_PENALTY = 10.0
#: Texts that share a dictionary, by their bytes or those of their words' places, whichever are more.
CHUNK = 32_000_000
#: Bytes of text for each hash bucket of words.
PER_BUCKET = 4_000_000
#: Characters of a word that begin in one stretch of it.
STRETCH = 64
#: Texts that are packed together.
TOGETHER = 250

AUTO_BUCKETED = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
#: The most buckets a table may have, by Spark's default.
MOST_BUCKETS = 100_000


@dataclass(frozen=True)
class Vocabulary:
    """The pieces of a model with their ids and scores, and the ids of bytes for unknown characters."""

    pieces: tuple[tuple[str, int, float], ...]
    byte_ids: tuple[int, ...]
    unknown_id: int

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)

    @property
    def unknown_score(self) -> float:
        return min(s for _, _, s in self.pieces) - UNKNOWN_PENALTY

    @cached_property
    def scores(self) -> np.ndarray:
        """The score of each piece, by id."""
        found = np.zeros(max(i for _, i, _ in self.pieces) + 1)
        for _, i, score in self.pieces:
            found[i] = score
        return found

    def rows(self, spark: SparkSession) -> DataFrame:
        """An Arrow table needs no Python workers of its own, as a list does."""
        pieces, ids, _ = zip(*self.pieces, strict=True)
        return spark.createDataFrame(pa.table({"piece": pa.array(pieces, pa.string()), "id": pa.array(ids, pa.int32())}))

    def cutter(self) -> Cutter:
        """A text may be cut before a space mark, around control characters and between a letter and
        a mark, if no piece has such a pair inside."""
        inside = {a + b for p, _, _ in self.pieces for a, b in zip(p, p[1:])}
        known = {c for p, _, _ in self.pieces for c in p}
        after_letter = {b for a, b in inside if a.isalpha()}
        return Cutter(
            spaces=not any(b == SPACE != a for a, b in inside),
            controls="".join(f"\\x{c:02x}" for c in range(32) if chr(c) not in known),
            marks="".join(f"\\x{ord(c):02x}" for c in ",.!?;:|()\"" if c not in after_letter),
        )


#: Stands between words while a text is cut; a text that holds it is not cut at all.
SEPARATOR = "\ufdd0"


@dataclass(frozen=True)
class Cutter:
    """Where texts are cut: before spaces, around controls, before marks that follow a letter."""

    spaces: bool
    controls: str
    marks: str

    def words(self, texts: pa.Array) -> pa.ListArray:
        """The words of each text, spelled with space marks; NULL and empty texts have none."""
        texts = pc.fill_null(texts, "")
        begun = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(SPACE, texts, ""))
        cut = pc.replace_substring(begun, " ", SPACE)
        plain = pc.invert(pc.match_substring(cut, SEPARATOR))
        if self.spaces:
            # Where no mark follows another, each but the first has a cut before it, without a pattern.
            single = pc.and_(plain, pc.invert(pc.match_substring(cut, SPACE + SPACE)))
            other = pc.replace_substring_regex(cut.filter(pc.invert(single)), f"([^{SPACE}])({SPACE})", rf"\1{SEPARATOR}\2")
            inner = pc.replace_substring(pc.utf8_slice_codeunits(cut, 1), SPACE, SEPARATOR + SPACE)
            first = pc.utf8_slice_codeunits(cut, 0, 1)
            spaced = pc.binary_join_element_wise(first, inner, "")
            cut = pc.if_else(plain, pc.replace_with_mask(spaced, pc.invert(single), other), cut)
        for wanted, pattern, spelled in (
            (self.marks, rf"(\pL)([{self.marks}])", rf"\1{SEPARATOR}\2"),
            (self.controls, f"([{self.controls}])", rf"{SEPARATOR}\1{SEPARATOR}"),
        ):
            if wanted:
                cut = pc.if_else(plain, pc.replace_substring_regex(cut, pattern, spelled), cut)
        lists = pc.split_pattern(cut, SEPARATOR)
        whole = pc.if_else(plain, None, cut)
        if pc.all(plain).as_py() is False:
            rows = [[w.as_py()] if w.is_valid else x.as_py() for w, x in zip(whole, lists, strict=True)]
            lists = pa.array(rows, pa.list_(pa.string()))
        # Cuts that meet leave empty words; they go.
        flat, filled = lists.flatten(), pc.not_equal(lists.flatten(), "")
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
        return pa.ListArray.from_arrays(pa.array(before[offsets].astype(np.int32)), flat.filter(filled))


def load(path: str) -> Vocabulary:
    """The vocabulary of a model file; its pieces must have scores that add up along a path."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    byte_ids = tuple(i for i in ids if model.is_byte(i))
    return Vocabulary(
        tuple((model.id_to_piece(i), i, model.get_score(i)) for i in plain),
        byte_ids if len(byte_ids) == 256 else (),
        model.unk_id(),
    )


def edges(stretches: DataFrame, pieces: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(bucket, at, piece) from the stretches (bucket, number, base, word) of words: each substring that
    is a piece, and each single unknown character, whose id is -1 less its code point. `at` is a pair of
    the word's number and the start, `piece` one of size and id; rows are many and therefore narrow."""
    n, longest = F.length("word"), vocabulary.longest
    starts = stretches.withColumn("start", F.explode(F.sequence(F.lit(0), F.least(n, F.lit(STRETCH)) - 1)))
    sizes = F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), n - F.col("start")))).alias("size")
    cut = starts.select("bucket", "number", "base", "word", "start", sizes).select(
        "bucket",
        "number",
        (F.col("base") + F.col("start")).alias("start"),
        "size",
        F.substring("word", F.col("start") + 1, F.col("size")).alias("spelled"),
    )
    # The piece table is the model's vocabulary, a file of fixed size.
    met = cut.join(F.broadcast(pieces), F.col("spelled") == F.col("piece"), "left")
    known = F.col("id").isNotNull()
    ids = F.coalesce("id", -1 - F.ascii("spelled")).alias("id")
    found = met.where(known | (F.col("size") == 1)).select("bucket", "number", "start", "size", ids)
    return found.select("bucket", pair("number", "start").alias("at"), pair("size", "id").alias("piece"))


def pair(high: str, low: str) -> Column:
    """Two numbers of 32 bits in one of 64."""
    return F.shiftleft(F.col(high).cast("long"), 32).bitwiseOR(F.col(low).cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))


def unpaired(pairs: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    both = pairs.to_numpy().astype("<i8", copy=False).view("<i4")
    return both[1::2], both[::2]


def best_paths(
    number: np.ndarray, start: np.ndarray, size: np.ndarray, ids: np.ndarray, score: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The ids on the path with the largest sum of scores of each word, one word after the other, and
    how many each has; of equal paths that with the longer last piece, as the reference encoders choose.

    Words have numbers from 0. All words go forward together, a position at a time, and then back.
    """
    end = start + size
    length = np.zeros(number.max(initial=-1) + 1, np.int64)
    np.maximum.at(length, number, end)
    # The places of a word, from 0 to its length, lie one after the other.
    base = np.cumsum(length + 1) - length - 1
    into, places = base[number] + end, int((length + 1).sum())
    # By position, then by place, then longer pieces first.
    longest = int(size.max(initial=0))
    order = np.argsort((end.astype(np.int64) * places + into) * (longest + 1) + longest - size)
    into, ids, score, end = into[order], ids[order], score[order], end[order]
    out = into - size[order]
    del order
    firsts = np.flatnonzero(np.diff(into, prepend=-1))
    counts = np.diff(firsts, append=len(into))
    owner = np.repeat(np.arange(len(firsts)), counts)
    steps = np.flatnonzero(np.diff(end[firsts], prepend=-1)).tolist()
    best, back = np.zeros(places), np.zeros(places, np.int64)
    for i, j in zip(steps, [*steps[1:], len(firsts)], strict=False):
        low, high = firsts[i], firsts[j] if j < len(firsts) else len(into)
        total = best[out[low:high]] + score[low:high]
        top = np.maximum.reduceat(total, firsts[i:j] - low)
        hits = np.flatnonzero(total == np.repeat(top, counts[i:j])) + low
        best[into[firsts[i:j]]] = top
        back[into[firsts[i:j]]] = hits[np.diff(owner[hits], prepend=-1) > 0]

    word, at, path = np.arange(len(length)), base + length, []
    while len(word):
        edge = back[at]
        path.append((word, ids[edge]))
        at = out[edge]
        word, at = word[at > base[word]], at[at > base[word]]
    words, found = (np.concatenate(x) for x in zip(*reversed(path), strict=True)) if path else (word, ids)
    return found[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(length))


def give_back() -> None:
    """Returns what this worker has freed; it lives on, beside those of the next stage."""
    pa.default_memory_pool().release_unused()


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, a plane of bytes after the other, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor().compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_words(words: list[str]) -> tuple[bytes, bytes]:
    spelled = [w.encode() for w in words]
    sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
    return pack(sizes), zstandard.ZstdCompressor().compress(b"".join(spelled))


def unpack_words(sizes: bytes, data: bytes) -> list[str]:
    ends = np.cumsum(unpack(sizes).astype(np.int64)).tolist()
    spelled = zstandard.ZstdDecompressor().decompress(data)
    return [spelled[i:j].decode() for i, j in zip([0, *ends], ends, strict=False)]


def cut_words(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str, buckets: int, most: int) -> DataFrame:
    """The documents by chunks of one task's texts, in rows of three kinds: the keys of some texts,
    how many words each has and the words' places in the chunk's list; the words of the list that
    fall into one bucket; and the buckets of the whole list, by which these are put together again."""
    kind = docs.schema[key].dataType.simpleString()
    cutter = vocabulary.cutter()
    names = ["chunk", "keys", "counts", "places", "bucket", "sizes", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        first, size = TaskContext.get().partitionId() << 32, 0
        chunk = first
        places: dict[str, int] = {}
        types: list[pa.DataType] = []

        def rows(*columns: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        def distinct() -> Iterator[pa.RecordBatch]:
            words = np.array(list(places), object)
            at = np.fromiter((xxhash.xxh32_intdigest(w.encode()) % buckets for w in places), np.int64, len(places))
            yield rows([chunk], [None], [None], [pack(at)], [None], [None], [None])
            order = np.argsort(at, kind="stable")
            starts = np.flatnonzero(np.concatenate([[True], at[order][1:] != at[order][:-1]]))
            for i, j in zip(starts, [*starts[1:], len(order)], strict=True):
                sizes, data = pack_words(words[order[i:j]].tolist())
                yield rows([chunk], [None], [None], [None], [int(at[order[i]])], [sizes], [data])

        for batch in batches:
            key_type = batch.schema.field(0).type
            types = [pa.int64(), pa.list_(key_type), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
            for piece in (batch.slice(k, TOGETHER) for k in range(0, batch.num_rows, TOGETHER)):
                if size > most:
                    yield from distinct()
                    chunk, size = chunk + 1, 0
                    places.clear()
                words = cutter.words(piece.column(1))
                coded = words.flatten().dictionary_encode()
                place = [places.setdefault(w, len(places)) for w in coded.dictionary.to_pylist()]
                at = np.array(place, "<u4")[coded.indices.to_numpy()] if len(place) else np.zeros(0, "<u4")
                size += max(at.nbytes, pc.sum(pc.binary_length(piece.column(1))).as_py() or 0)
                keys = pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), piece.column(0))
                yield rows([chunk], keys, [pack(np.diff(words.offsets.to_numpy()))], [pack(at)], [None], [None], [None])
        if places:
            yield from distinct()
        places.clear()
        give_back()

    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"chunk long, keys array<{kind}>, counts binary, places binary, bucket int, sizes binary, words binary"
    return map_batches(given, run, schema)


def numbered(lists: DataFrame, longest: int) -> DataFrame:
    """The lists (chunk, bucket, sizes, words) bucket by bucket: a number for each distinct word, with
    its stretches (number, base, word), and for each list the numbers of its words.

    A stretch has up to `STRETCH` characters that pieces may begin with, and what they may end with.
    """

    def run(group: pa.Table) -> pa.Table:
        known: dict[str, int] = {}
        packed = []
        for sizes, words in zip(group["sizes"], group["words"], strict=True):
            found = [known.setdefault(w, len(known)) for w in unpack_words(sizes.as_py(), words.as_py())]
            packed.append(pack(np.array(found, np.uint32)))
        if max(map(len, known)) <= STRETCH:
            number, base, word = list(range(len(known))), [0] * len(known), list(known)
        else:
            cuts = [(i, k, w[k : k + STRETCH + longest - 1]) for w, i in known.items() for k in range(0, len(w), STRETCH)]
            number, base, word = map(list, zip(*cuts, strict=True))
        n, m = len(number), len(packed)
        found = pa.table({
            "bucket": pa.array([group["bucket"][0].as_py()] * (n + m), pa.int32()),
            "number": pa.array(number + [None] * m, pa.int32()),
            "base": pa.array(base + [None] * m, pa.int32()),
            "word": pa.array(word + [None] * m, pa.string()),
            "chunk": pa.concat_arrays([pa.nulls(n, pa.int64()), *group["chunk"].chunks]),
            "numbers": pa.array([None] * n + packed, pa.binary()),
        })
        del known, packed, number, base, word
        give_back()
        return found

    schema = "bucket int, number int, base int, word string, chunk long, numbers binary"
    return lists.groupBy("bucket").applyInArrow(run, schema)


def lists_of(flat: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists at the places `at` of those that lie one after the other in `flat`, and their sizes."""
    starts, n = np.cumsum(sizes) - sizes, sizes[at]
    # For each entry its place in the flat list: its list's start and the steps since.
    steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return flat[np.repeat(starts[at], n) + steps], n


def binaries(ids: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """The bytes of the ids between bounds, without a copy unless they are more than an array's 2 GB."""
    if 4 * bounds[-1] < 1 << 31:
        offsets = pa.py_buffer((4 * bounds).astype(np.int32))
        return [pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(ids)])]
    rows = zip(bounds.tolist(), bounds[1:].tolist(), strict=False)
    return [pa.array([ids[i:j].tobytes()], pa.binary()) for i, j in rows]


def with_bytes(flat: np.ndarray, sizes: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of paths, where an unknown character gives those of its bytes, or else the unknown id."""
    unknown = np.flatnonzero(flat < 0)
    if not len(unknown):
        return flat, sizes
    if not vocabulary.byte_ids:
        return np.where(flat < 0, vocabulary.unknown_id, flat), sizes
    table = np.array(vocabulary.byte_ids)
    spelled = {c: table[np.frombuffer(chr(-1 - c).encode("utf-8", "surrogatepass"), np.uint8)] for c in np.unique(flat[unknown]).tolist()}
    n = np.ones(len(flat), np.int64)
    n[unknown] = [len(spelled[c]) for c in flat[unknown].tolist()]
    out = np.repeat(flat, n)
    ends = np.cumsum(n)
    for k in unknown.tolist():
        out[ends[k] - n[k] : ends[k]] = spelled[int(flat[k])]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return out, np.bincount(owner, n, len(sizes)).astype(np.int64)


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    key: str = "doc_id",
    text: str = "text",
    per_bucket: int = PER_BUCKET,
    chunk: int = CHUNK,
) -> DataFrame:
    """(key, ids): the ids of each whole text as little-endian unsigned 32-bit numbers, a row for
    each given row, also if its key is NULL or repeats. A NULL or empty text has none. Other columns
    take no part, whatever their names."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = 1 + size // per_bucket
    wide = max(int(spark.conf.get(k, None) or 1) for k in ("spark.sql.shuffle.partitions", INITIAL_PARTITIONS))
    cut = bucketed(cut_words(docs, vocabulary, key, text, buckets, chunk), "words", "chunk", min(wide, MOST_BUCKETS))
    lists = cut.where("bucket IS NOT NULL").select("chunk", "bucket", "sizes", "words")
    words = bucketed(numbered(lists, vocabulary.longest), "numbers", "bucket", min(buckets, MOST_BUCKETS))

    def spell(lattice: pa.Table, lists: pa.Table) -> pa.Table:
        (number, start), (size, ids) = unpaired(lattice["at"]), unpaired(lattice["piece"])
        score = np.where(ids < 0, vocabulary.unknown_score, vocabulary.scores[np.maximum(ids, 0)])
        flat, sizes = with_bytes(*best_paths(number, start, size, ids, score), vocabulary)
        del number, start, size, ids, score
        counts, paths = [], []
        for packed in lists["numbers"]:
            found, n = lists_of(flat, sizes, unpack(packed.as_py()))
            counts.append(pack(n))
            paths.append(pack(found))
        del flat, sizes
        give_back()
        return pa.table({
            "chunk": lists["chunk"],
            "bucket": lists["b"],
            "counts": pa.array(counts, pa.binary()),
            "ids": pa.array(paths, pa.binary()),
        })

    with session_conf(spark, {AUTO_BUCKETED: "false"}):
        stretches = words.where("word IS NOT NULL").select("bucket", "number", "base", "word")
        lattice = edges(stretches, vocabulary.rows(spark), vocabulary)
        used = words.where("numbers IS NOT NULL").select(F.col("bucket").alias("b"), "chunk", "numbers")
        spelled = lattice.groupBy("bucket").cogroup(used.groupBy("b"))
        found = written(spelled.applyInArrow(spell, "chunk long, bucket int, counts binary, ids binary"), "paths")

    kind = docs.schema[key].dataType.simpleString()

    def put_together(texts: pa.Table, words: pa.Table) -> pa.Table:
        # The words of each bucket are in the order of the list, whose buckets are a row without keys.
        give_back()
        rows = list(zip(texts["counts"], texts["places"], strict=True))
        packed = [places.as_py() for counts, places in rows if not counts.is_valid]
        rows = [(counts, places) for counts, places in rows if counts.is_valid]
        words = words.sort_by("bucket")
        parts = [unpack(c.as_py()) for c in words["counts"]]
        sizes = np.concatenate([np.zeros(0, np.int64), *parts])
        flat = np.concatenate([np.zeros(0, "<u4"), *(unpack(c.as_py()) for c in words["ids"])])
        place = np.empty(len(sizes), np.int64)
        place[np.argsort(unpack(packed[0]) if packed else place, kind="stable")] = np.arange(len(sizes))
        keys, blocks = texts["keys"].combine_chunks().flatten(), []
        # One array for all ids, which goes back whole as it is freed; the rows are parts of it.
        out, at = np.empty(sum(int(sizes[place[unpack(places.as_py())]].sum()) for _, places in rows), "<u4"), 0
        for counts, places in rows:
            ids, n = lists_of(flat, sizes, place[unpack(places.as_py())])
            # Where each text ends, in words and then in ids.
            ends = np.cumsum(unpack(counts.as_py()).astype(np.int64))
            bounds = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], ends])]
            out[at : at + len(ids)] = ids
            blocks += binaries(out[at : at + len(ids)], bounds)
            at += len(ids)
        del parts, sizes, flat, place, words, texts, rows, packed
        give_back()
        return pa.table({"key": keys, "ids": pa.chunked_array(blocks, pa.binary())})

    texts = cut.where("bucket IS NULL").select(F.col("chunk").alias("c"), "keys", "counts", "places")
    joined = texts.groupBy("c").cogroup(found.groupBy("chunk")).applyInArrow(put_together, f"key {kind}, ids binary")
    return joined.withColumnRenamed("key", key)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds `text`: pieces put together, bytes as UTF-8, space marks as spaces but the first. A column
    of that name is replaced. NULL has the empty text."""
    spelled = {i: p.replace(SPACE, " ").encode() for p, i, _ in vocabulary.pieces}
    spelled |= {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
    table = pa.array([spelled.get(i, b" \xe2\x81\x87 ") for i in range(max(spelled) + 2)], pa.large_binary())
    kept = [f for f in encoded.schema.fields if f.name != text]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (given.slice(k, 100) for given in batches for k in range(0, given.num_rows, 100)):
            packed = [p.as_py() or b"" for p in batch.column(ids)]
            at = np.minimum(np.frombuffer(b"".join(packed), "<u4"), len(table) - 1)
            found = table.take(pa.array(at))
            # The bytes of each text lie one after the other.
            places = np.frombuffer(found.buffers()[1], np.int64, len(at) + 1)
            data = found.buffers()[2].to_pybytes() if len(at) else b""
            ends = places[np.cumsum([0, *(len(p) // 4 for p in packed)])].tolist()
            texts = [data[i:j].decode("utf-8", "replace").removeprefix(" ") for i, j in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())], [*names, text])

    return map_batches(encoded, run, schema)
