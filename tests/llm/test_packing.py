"""Packing against the tokenizer itself, put together by hand."""

import json
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import packing
from strata.llm.packing import WordEncoder, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, start int, part int"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def word_encoder():
    return WordEncoder(PATH)


def check(rows, texts, tokenizer, window):
    ids = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for t in texts]
    sequences = {}
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids == own.tobytes() and r.ids_crc32 == zlib.crc32(own.tobytes())
        assert r.continues == (r.start + r.length < r.doc_tokens)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    lengths = []
    for k in sorted(sequences):
        end = 0
        for offset, length in sorted(sequences[k]):
            assert offset == end
            end += length
        lengths.append(end)
    assert all(n == window for n in lengths[:-1]) and sum(lengths) == sum(map(len, ids))
    assert sorted(sequences) == list(range(len(sequences)))


def test_all_ids_once_without_gaps(spark, tokenizer):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(("then", "Thing,", "été.", "x1", "don't")) for _ in range(rng.randrange(400))) for _ in range(60)]
    texts += [None, "", " ", "<|endoftext|> a", "word " * 9000]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    for window in (2048, 7):
        check(pack(docs, PATH, window).collect(), texts, tokenizer, window)


def test_empty_table_null_and_repeated_keys(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (3, "b"), (3, "b")], "doc_id long, text string")
    found = pack(docs, PATH).collect()
    assert len(found) == 4 and sorted(r.offset for r in found) == [0, 2, 4, 6]
    assert pack(docs.limit(0), PATH).collect() == []


@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aZé'.,!?<|> \n\tİσΣ1_̧́")), max_size=80))
def test_word_by_word_is_the_whole_text(tokenizer, word_encoder, text):
    whole = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert word_encoder.encode(pa.array(["", text, None, "a, b"]))[1].tobytes() == whole


def variants(token):
    return [token, token.upper(), token.title(), token[:-1], token[0].upper() + token[1:-2] + token[-2:].upper(), token.replace("|", " |")]


def test_added_tokens_in_any_case(tokenizer, word_encoder):
    """Only the spelling of an added token itself is a control token; other cases are text."""
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    assert "<|endoftext|>" in added
    texts = [form.format(v) for token in added for v in variants(token) for form in ("{}", "a{}b", "One, {} two {}.".replace("{} two {}", "{0} two {0}"))]
    texts += ["".join(rng.choice("<|EnDoFtExT|>") for _ in range(30)) for rng in map(random.Random, range(50))]
    expected = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [ids.tobytes() for ids in word_encoder.encode(pa.array(texts))] == expected


def test_other_tokenizers_are_refused(tmp_path):
    whole = json.loads(Path(PATH).read_text())
    cased = {**whole, "normalizer": None}
    crossing = {**whole, "pre_tokenizer": None}
    for k, other in enumerate((cased, crossing)):
        path = tmp_path / f"{k}.json"
        path.write_text(json.dumps(other))
        with pytest.raises(ValueError, match="not encoded apart"):
            WordEncoder(str(path))
    with pytest.raises(ValueError, match="not encoded apart"):
        WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_parts_of_a_batch_are_bounded_in_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 5, None, "", "b" * 20, "c", "d" * 4])], ["k", "t"])
    assert [p.column(0).to_pylist() for p in packing.by_bytes(batch, 1, 5)] == [[0, 1, 2], [3], [4, 5]]


def test_forgotten_words_are_learned_again(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    small = WordEncoder(PATH)
    texts = ["one two, three", "four five six, one", "one two seven eight, two,"] * 2
    whole = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [small.encode(pa.array([t]))[0].tobytes() for t in texts] == whole
    assert [ids.tobytes() for ids in small.encode(pa.array(texts))] == whole
    assert len(small.recent) <= 3 and len(small.older) <= 3
