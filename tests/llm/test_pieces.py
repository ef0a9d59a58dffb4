"""The lattice against a plain Viterbi, the library's own unigram encoder, and round trips."""

import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from strata.llm import pieces
from strata.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
#: Appended to a model file, this makes the library treat its pieces as those of a unigram model.
AS_UNIGRAM = b"\x12\x02\x18\x01"
TEXTS = [
    "Hello world, this is a test.", "  two  spaces ", "tab\tand\nline\r\nbreaks", "naïve café", "日本語 テキスト 𐍈 ü", "x" * 300,
    "a.b,c;d!e?(f)\"g\"|h:i", "", " ", None, "▁literal mark", "1234567890 3.14", "\x00\x01 control", "ofthethe whonding, ofthethe"]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(PATH)


def marked(text):
    return "▁" + text.replace(" ", "▁") if text else ""


def viterbi(text, vocabulary, tables={}):  # noqa: B006 (one table for each vocabulary)
    if id(vocabulary) not in tables:
        scores = {p: (s, i) for p, i, s in vocabulary.pieces}
        tables[id(vocabulary)] = scores, vocabulary.longest, vocabulary.unknown_score
    best, longest, unknown_score = tables[id(vocabulary)]
    s, score, back = marked(text), [0.0], [None]
    for end in range(1, len(s) + 1):
        options = []
        for start in range(max(0, end - longest), end):
            found = best.get(s[start:end]) or ((unknown_score, -1) if end - start == 1 else None)
            if found:
                options.append((score[start] + found[0], -start, found[1]))
        top = max(options)
        score.append(top[0])
        back.append((-top[1], top[2]))
    out, end = [], len(s)
    while end:
        start, i = back[end]
        out.append([i] if i >= 0 else [vocabulary.byte_ids[b] for b in s[start:end].encode()])
        end = start
    return [i for part in reversed(out) for i in part]


def encoded(spark, vocabulary, texts):
    docs = spark.createDataFrame([(i, t, 1, [2], "w") for i, t in enumerate(texts)], "doc_id long, text string, ids int, places array<int>, word string")
    found = pieces.decode(pieces.encode(docs.repartition(3), vocabulary), vocabulary).collect()
    return {r.doc_id: (np.frombuffer(r.ids, "<u4").tolist(), r.text) for r in found}


def test_encode_and_decode(spark, vocabulary):
    model = sentencepiece.SentencePieceProcessor(model_proto=open(PATH, "rb").read() + AS_UNIGRAM)
    found = encoded(spark, vocabulary, TEXTS)
    for i, text in enumerate(TEXTS):
        ids, back = found[i]
        assert ids == viterbi(text, vocabulary) == model.encode(text or "")
        assert back == (text or "").replace("▁", " ")


def test_random_texts(spark, vocabulary):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abehint ,.é\n▁中-0") for _ in range(rng.randrange(60))) for _ in range(60)]
    found = encoded(spark, vocabulary, texts + texts[:5])
    assert {i: ids for i, (ids, _) in found.items()} == {i: viterbi(t, vocabulary) for i, t in enumerate(texts + texts[:5])}


def test_many_chunks_and_buckets(spark, vocabulary):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abehint ,.é\n▁中") for _ in range(rng.randrange(80))) for _ in range(2500)]
    texts[7] = texts[1200] = None
    docs = spark.createDataFrame([(i % 2400, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(2)
    found = pieces.encode(docs, vocabulary, per_bucket=20_000, chunk=1000).collect()
    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in found) == sorted(
        (i % 2400, viterbi(t, vocabulary)) for i, t in enumerate(texts)
    )


def test_long_words(spark, vocabulary):
    rng = random.Random(4)
    sizes = [63, 64, 65, 78, 79, 80, 128, 129, 255, 256, 257, 511, 513, 4000]
    texts = ["".join(rng.choice("abehinté中") for _ in range(n)) for n in sizes] + ["e" * 3000, "中" * 1000]
    found = encoded(spark, vocabulary, texts)
    assert {i: ids for i, (ids, _) in found.items()} == {i: viterbi(t, vocabulary) for i, t in enumerate(texts)}


def test_time_grows_as_a_word_does(spark, vocabulary):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(200_000))
    began = time.monotonic()
    found = encoded(spark, vocabulary, [text])
    assert time.monotonic() - began < 60
    assert found[0][0] == viterbi(text, vocabulary) and found[0][1] == text


def lattice(vocabulary, words):
    """The edges of words, in no order: number, start, size, id, score."""
    known = {p: (i, s) for p, i, s in vocabulary.pieces}
    edges, longest = [], vocabulary.longest
    for number, word in enumerate(words):
        for start in range(len(word)):
            for size in range(1, min(longest, len(word) - start) + 1):
                found = known.get(word[start : start + size])
                if found:
                    edges.append((number, start, size, *found))
    random.Random(6).shuffle(edges)
    *whole, score = (np.array(column) for column in zip(*edges, strict=True))
    return *(np.array(column, np.int32) for column in whole), score


def test_words_of_a_bucket_go_together(vocabulary):
    """The best paths of 20,000 words and a long one, in a second or so of one core."""
    rng = random.Random(7)
    words = ["▁" + "".join(rng.choice("abehint") for _ in range(rng.randrange(1, 9))) for _ in range(20_000)] + ["abehint" * 300]
    edges = lattice(vocabulary, words)
    began = time.process_time()
    ids, sizes = pieces.best_paths(*edges)
    assert time.process_time() - began < 4
    assert len(sizes) == len(words) and sizes.sum() == len(ids)
    ends = np.cumsum(sizes)
    for k in [*range(200), len(words) - 1]:
        plain = words[k].removeprefix("▁")
        if plain != words[k]:
            assert ids[ends[k] - sizes[k] : ends[k]].tolist() == viterbi(plain, vocabulary)
    spelled = {i: p for p, i, _ in vocabulary.pieces}
    assert "".join(spelled[i] for i in ids[ends[-2] :].tolist()) == words[-1]


def test_of_equal_paths_the_one_with_the_longer_last_piece(vocabulary):
    # a|bc, ab|c and a|b|c add up to the same.
    number, start, size = np.zeros(5, np.int32), np.array([0, 0, 1, 1, 2], np.int32), np.array([1, 2, 1, 2, 1], np.int32)
    ids, score = np.array([10, 11, 12, 13, 14], np.int32), np.array([-1.0, -2.0, -1.0, -2.0, -1.0])
    assert [x.tolist() for x in pieces.best_paths(number, start, size, ids, score)] == [[10, 13], [2]]
    none = np.zeros(0, np.int32)
    assert [x.tolist() for x in pieces.best_paths(none, none, none, none, np.zeros(0))] == [[], []]


def test_rows_without_key_and_columns_of_that_name(spark, vocabulary):
    rows = [(None, "a b", 1), (None, "c", 2), (3, None, 3), (3, "", 4), (3, "d", 5)]
    docs = spark.createDataFrame(rows, "chunk long, text string, bucket long")
    found = pieces.encode(docs, vocabulary, "chunk", "text")
    back = pieces.decode(found.withColumn("text", F.lit(7)), vocabulary)
    assert back.columns == ["chunk", "ids", "text"]
    assert sorted(((r.chunk or 0), r.text) for r in back.collect()) == [(0, "a b"), (0, "c"), (3, ""), (3, ""), (3, "d")]


def test_numbers_and_words_are_packed_and_unpacked():
    for numbers in ([], [0], [1, 2**32 - 1, 256, 65536]):
        assert pieces.unpack(pieces.pack(np.array(numbers, np.int64))).tolist() == numbers
    for words in ([], ["a"], ["▁中", "\n", "𐍈x"]):
        assert pieces.unpack_words(*pieces.pack_words(words)) == words


def test_words_cover_the_text_and_no_piece_crosses_them(vocabulary):
    texts = [*TEXTS, "a\ufdd0 b,c", ",,a,,", "▁▁ ▁a▁"]
    words = vocabulary.cutter().words(pa.array(texts)).to_pylist()
    assert ["".join(w) for w in words] == [marked(t) for t in texts]
    assert words[0] == ["▁Hello", "▁world", ",", "▁this", "▁is", "▁a", "▁test", "."]
    assert words[1] == ["▁▁▁two", "▁▁spaces", "▁"] and words[2][:4] == ["▁tab", "\t", "and", "\n"]
    known = {p for p, _, _ in vocabulary.pieces}
    for text in words[:12]:
        for a, b in zip(text, text[1:]):
            assert not any(a[-i:] + b[:j] in known for i in range(1, 9) for j in range(1, 9))


def test_without_bytes_unknown_characters_are_unknown(spark, vocabulary):
    small = pieces.Vocabulary((("▁", 5, -1.0), ("a", 6, -2.0), ("▁a", 7, -2.5)), (), 0)
    found = encoded(spark, small, ["a ab"])
    assert found[0][0] == [7, 7, 0]


def test_pieces_start_no_workers_and_spell_rows(spark, vocabulary):
    """A list of pieces would start Python workers of its own."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    ids = [np.array([i, 300], "<u4").tobytes() for i in range(259, 400)] + [None, b""]
    docs = spark.createDataFrame([(i, bytes(p) if p is not None else None) for i, p in enumerate(ids)], "doc_id long, ids binary")
    found = pieces.decode(docs, vocabulary)
    spelled = {i: p.replace("▁", " ") for p, i, _ in vocabulary.pieces}
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts == {i: (spelled[259 + i] + spelled[300]).removeprefix(" ") if p else "" for i, p in enumerate(ids)}
    assert pieces.decode(docs, vocabulary, text="ids").columns == ["doc_id", "ids"]
    assert "ExistingRDD" not in plan(vocabulary.rows(spark))
    assert {(r.piece, r.id) for r in vocabulary.rows(spark).collect()} == {(p, i) for p, i, _ in vocabulary.pieces}


def test_texts_of_long_words_share_a_dictionary_by_their_bytes(spark, vocabulary):
    texts = [f"{i}" * 1000 for i in range(100, 2100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    cut = pieces.cut_words(docs, vocabulary, "doc_id", "text", 1, 1_000_000)
    chunks = cut.where("keys IS NOT NULL").select("chunk", F.size("keys").alias("n")).collect()
    assert sum(r.n for r in chunks) == 2000 and len({r.chunk for r in chunks}) >= 4


def test_ids_are_cut_into_rows():
    ids, bounds = np.arange(10, dtype="<u4"), np.array([0, 3, 3, 10])
    for whole in (bounds, bounds.astype(np.int32)):
        assert [x.as_py() for a in pieces.binaries(ids, whole) for x in a] == [ids[:3].tobytes(), b"", ids[3:].tobytes()]


def test_empty_table(spark, vocabulary):
    assert encoded(spark, vocabulary, []) == {}


def test_query_decodes_every_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in QUERIES["op4_pieces"](spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(docs)
    for d in docs:
        ids = np.frombuffer(found[d.doc_id].ids, "<u4")
        assert len(ids) == found[d.doc_id].n_pieces
        assert found[d.doc_id].text == (d.text or "").replace("▁", " ")
