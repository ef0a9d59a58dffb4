"""Packing: all documents as one stream of token ids, cut into windows of fixed length."""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_batches, remembered, written

#: Words whose ids a Python worker remembers at least, if they came up lately; twice as many at most.
REMEMBERED = 200_000
#: Words encoded in one call, and bytes of texts whose words are looked up at a time.
TOGETHER, PIECE = 5_000, 4 << 20
#: A mark at the end of a word; a token never holds a letter and one of them.
MARKED = r"([a-z])([,.!?;:])([ \n])"
#: Fixed value: the parts of an ASCII word in lower case, none of which a token crosses.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


#: Texts by which a tokenizer shows whether it is of the kind that WordEncoder takes.
TRIALS = [
    "Two words, and don't; it's 12.5%... (x_1) A.B! we'll--ok?",
    "tab\tline\nfeed  two\r\n end. a,b;c:d!e?f 's 't ''re",
    "été ÉTÉ naïve İstanbul ΣΟΦΟΣ 中文 字。 e\u0301 𝒳1 \u00a0x\u3000y ſ K",
    "<|endof text|> <s> [INST] </w> a</w>b #$%^&*()~`{}|\\",
]


class WordEncoder:
    """Ids of whole texts, by way of the ids of their words.

    Only for tokenizers that ignore case, drop white space, have PARTS with a token at the end of
    each that is marked so, and no token or rule of which crosses ASCII white space or goes from a
    letter to a mark: the ids of a text are then those of its words and marks, one after the other.
    What can be checked of that is, at load: how the tokenizer is declared, and that it gives trial
    texts the same ids; another one is refused. Added tokens are found before case is dropped, so a
    text that holds one in any case is encoded whole, as it is spelled.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, k in self.tokenizer.get_vocab().items():
            self.ends[k] = token.endswith("</w>")
        declared = json.loads(self.tokenizer.to_str())
        self.added = [t["content"].lower() for t in declared["added_tokens"]]
        self.check(declared)

    def check(self, declared: dict) -> None:
        normalizer = json.dumps(declared["normalizer"])
        fine = (
            declared["model"]["type"] == "BPE"
            and declared["model"].get("end_of_word_suffix") == "</w>"
            and '"Lowercase"' in normalizer
            and not declared["truncation"]
            and not declared["padding"]
        )
        trials = [*TRIALS, *(f"a {t} {t.upper()} {t.title()}b" for t in self.added)]
        if not fine or [x.tobytes() for x in self.encode(pa.array(trials))] != self.whole(trials):
            raise ValueError("words and marks of this tokenizer are not encoded apart")

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; NULL counts as empty."""
        lower = pc.ascii_lower(pc.fill_null(texts, ""))
        spelled = np.zeros(len(texts), bool)
        for token in self.added:
            spelled |= pc.match_substring(lower, token).to_numpy(zero_copy_only=False)
        if spelled.any():
            lower = pc.if_else(pa.array(spelled), "", lower)
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, MARKED, r"\1 \2\3"))
        coded = words.flatten().dictionary_encode()
        found = pa.array(self.words(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        # The ids of all words, one after the other, and where each begins.
        taken = found.take(coded.indices)
        starts = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, 8 * taken.offset) // 4
        ids = np.frombuffer(taken.buffers()[2] or b"", "<u4")
        ends = starts[words.offsets.to_numpy() - words.offsets[0].as_py()]
        out = [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        places = np.flatnonzero(spelled)
        for k, own in zip(places, self.whole(texts.take(pa.array(places)).to_pylist()), strict=True):
            out[k] = np.frombuffer(own, "<u4")
        return out

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words as little-endian unsigned 32-bit numbers."""
        found = list(map(self.recent.get, words))
        missing = [word for word, ids in zip(words, found, strict=True) if ids is None]
        known = {word: ids for word in missing if (ids := self.older.get(word)) is not None} if self.older else {}
        known |= self.learn([word for word in missing if word not in known] if known else missing)
        self.remember(known)
        return [known[word] if ids is None else ids for word, ids in zip(words, found, strict=True)]

    def remember(self, known: dict[str, bytes]) -> None:
        if len(self.recent) + len(known) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        self.recent.update(islice(known.items(), REMEMBERED))

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words. Parts of printable ASCII words go to the model as they are; what else is all
        letters goes to the tokenizer together, the rest each for itself."""
        model, known = self.tokenizer.model, {}
        letters, others = [], []
        for word in words:
            if word.isascii() and word.isprintable():
                parts = (word,) if word.isalpha() else PARTS.findall(word)
                ids = [token.id for part in parts for token in model.tokenize(part)]
                known[word] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                (letters if word.isalpha() else others).append(word)
        for start in range(0, len(letters), TOGETHER):
            some = letters[start : start + TOGETHER]
            known.update(zip(some, self.learn_together(some), strict=True))
        known.update(zip(others, self.whole(others), strict=True))
        return known

    def learn_together(self, words: list[str]) -> list[bytes]:
        """Words of one part each are encoded in one call; the last token of each tells them apart.
        Should that not come out even, each is encoded for itself."""
        whole = self.whole([" ".join(words)])[0]
        ends = 4 * (np.flatnonzero(self.ends[np.frombuffer(whole, "<u4")]) + 1)
        if len(ends) != len(words) or ends[-1] != len(whole):
            return self.whole(words)
        return [whole[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]

    def whole(self, texts: list[str]) -> list[bytes]:
        """The tokenizer's own ids of each text."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)  # keeps no offsets
        return [np.array(one.ids, "<u4").tobytes() for one in found]


def by_bytes(batch: pa.RecordBatch, text: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have so many bytes, or one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def tokenise(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """First pass, written once: key, ids of the document with `end_id` after them, and its place
    in the stream of its partition (part, local_start)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        own = remembered(f"packing {tokenizer}", lambda: WordEncoder(tokenizer))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for piece in by_bytes(batch, 1, PIECE):
                ids = [x.tobytes() + end for x in own.encode(piece.column(1))]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                before = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(ids), pa.int32()), piece.column(0), pa.array(before), pa.array(n), pa.array(ids, pa.binary())],
                    ["part", "key", "local_start", "n_tokens", "ids"],
                )

    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    stream = map_batches(given, run, f"part int, key {kind}, local_start long, n_tokens long, ids binary")
    return written(stream, "tokens")


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of documents by sequence: no id is lost or repeated, only the last sequence is short.

    A NULL text counts as empty: its document is the end id alone. Each row is a document of its
    own, also if its key is NULL or repeats. Columns: key, start, length, ids_crc32, doc_tokens,
    sequence_id, offset; `continues` marks a boundary record, whose document goes on in the next
    sequence; `ids` holds the ids.
    """
    tokens = tokenise(docs, tokenizer, end_id, key, text)
    # Second pass: a row for each written partition, so one small task, and small enough to send.
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select(
        "part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base")
    )
    placed = tokens.join(F.broadcast(before), "part").select(
        "key", "ids", (F.col("base") + F.col("local_start")).alias("at")
    )
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                piece = batch.slice(k, 1000)
                rows: list[tuple] = []
                source: list[int] = []
                for i, (ids, at) in enumerate(zip(piece.column(1), piece.column(2).to_pylist(), strict=True)):
                    whole = memoryview(ids.as_buffer())
                    n, start = len(whole) // 4, 0
                    while start < n:
                        place = at + start
                        length = min(n - start, window - place % window)
                        own = bytes(whole[4 * start : 4 * (start + length)])
                        source.append(i)
                        rows.append((start, length, zlib.crc32(own), n, place // window, place % window, start + length < n, own))
                        start += length
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), KINDS, strict=True)]
                    yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(source)), *columns], ["key", *NAMES])

    return map_batches(
        placed,
        cut,
        f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, continues boolean, ids binary",
    ).withColumnRenamed("key", key)


NAMES = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "continues", "ids"]
KINDS = [pa.int64()] * 6 + [pa.bool_(), pa.binary()]
