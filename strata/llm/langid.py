"""Language identification: softmax regression on TF-IDF character n-grams, with calibrated scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import ngrams
from strata.llm.common import crc32_of, draw, map_batches
from strata.llm.linear import Ftrl, logits_of, softmax, temperature

UNDETERMINED = "und"


@dataclass(frozen=True)
class Params:
    sizes: tuple[int, ...] = (1, 2, 3)
    bits: int = 13
    #: The classifier is fitted on so many rows of each language at most; document frequencies and
    #: predictions cover every row.
    rows_per_language: int = 500
    ftrl: Ftrl = field(default_factory=lambda: Ftrl(alpha=0.5, l1=0.002, l2=0.01, epochs=3))


@dataclass(frozen=True)
class Model:
    params: Params
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    heat: float

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return weighted(text, self.params, self.idf)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its probability; `und` and 0 for a text without a letter."""
        if not self.languages or not ngrams.has_letter(text):
            return UNDETERMINED, 0.0
        index, value = self.features(text)
        p = softmax((value @ self.weights[index] + self.weights[-1]) / self.heat)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def weighted(text: str, params: Params, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of the text with length 1: occupied buckets and their values."""
    tf = ngrams.counts(text, params.sizes, params.bits)
    index = np.flatnonzero(tf)
    value = np.log1p(tf[index]) * idf[index]
    return index, value / max(np.sqrt(value @ value), 1e-12)


def document_frequencies(texts: DataFrame, params: Params) -> tuple[int, np.ndarray]:
    """Rows, and rows that hold each bucket, over all of `texts`: partial sums in the tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = 0, np.zeros(1 << params.bits, np.int64)
        flags = np.zeros(1 << params.bits, np.uint8)
        for batch in batches:
            for text in batch.column(0):
                if ngrams.has_letter(text := text.as_py()):
                    rows += 1
                    held[ngrams.present(text, params.sizes, params.bits, flags)] += 1
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict(
            {"bucket": np.append(found, -1), "held": np.append(held[found], rows)}
        )

    parts = map_batches(texts, count, "bucket long, held long")
    sums = parts.groupBy("bucket").agg(F.sum("held").alias("held"))
    rows, held = 0, np.zeros(1 << params.bits, np.int64)
    for bucket, n in sums.collect():  # a row for each bucket at most
        if bucket < 0:
            rows = n
        else:
            held[bucket] = n
    return rows, held


def fit(labelled: DataFrame, key: str, text: str, label: str, params: Params = Params()) -> Model:
    """Learns from rows with a label and a letter in the text.

    Rows are drawn by a hash of `key` and the label, for each language alone; a fifth of them sets
    the temperature. Without any labelled row the model knows no language.
    """
    usable = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.col(text).alias("text"), F.col(label).alias("label")
    )
    rows, held = document_frequencies(usable.select("text"), params)
    idf = np.log((1.0 + rows) / (1.0 + held)) + 1.0
    drawn = draw(usable.select("key", "label").where("key IS NOT NULL"), "key", ["label"], params.rows_per_language)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"label": [], "place": [], "at": [], "value": []}
            for row in batch.to_pylist():
                if ngrams.has_letter(row["text"]):
                    index, value = weighted(row["text"], params, idf)
                    out["label"].append(row["label"])
                    out["place"].append(row["place"])
                    out["at"].append(index.astype("<u4").tobytes())
                    out["value"].append(value.astype("<f4").tobytes())
            yield pa.RecordBatch.from_pydict(
                out, pa.schema([("label", pa.string()), ("place", pa.int32()), ("at", pa.binary()), ("value", pa.binary())])
            )

    # Bounded by rows_per_language: the drawn keys go to the texts, and their features come here.
    chosen = usable.join(F.broadcast(drawn), ["key", "label"]).select("label", "place", "text")
    sample = map_batches(chosen, featurise, "label string, place int, at binary, value binary").collect()
    sample.sort(key=lambda r: (r.label, r.place, bytes(r.at)))
    languages = tuple(sorted({r.label for r in sample}))
    number = {name: k for k, name in enumerate(languages)}
    parts: tuple[list, list] = ([], [])
    for r in sample:
        row = (
            np.frombuffer(r.at, "<u4").astype(np.int64),
            np.frombuffer(r.value, "<f4").astype(np.float64),
            number[r.label],
        )
        parts[r.place % 5 == 0].append(row)
    learn, calibrate = parts
    if not languages:
        return Model(params, (), idf, np.zeros((1, 1)), 1.0)
    weights = params.ftrl.fit(learn, 1 << params.bits, len(languages))
    heat = temperature(logits_of(weights, calibrate), np.array([r[2] for r in calibrate], np.int64))
    return Model(params, languages, idf, weights, heat)


def training_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose checksum of the key is not divisible by 5; the others are held out."""
    return docs.where(crc32_of(key) % 5 != 0)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: key, lang_pred, score. Map-only; whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits lines for each language
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["key", "lang_pred", "score"],
            )

    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_batches(given, run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def keep(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents, all columns, whose language is determined with a score of `least` or more. NULL
    texts and those without a letter are undetermined and go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(at)]
            yield batch.filter(pa.array([n != UNDETERMINED and s >= least for n, s in found], pa.bool_()))

    return map_batches(docs, run, docs.schema)
