"""Toxicity: a classifier chain over category labels, each a linear model on character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import ngrams
from strata.llm.common import draw, map_batches, remembered
from strata.llm.linear import Ftrl, Row


@dataclass(frozen=True)
class Params:
    #: Label columns (0 or 1) in the order of the chain.
    chain: tuple[str, ...] = ("quality", "toxic")
    sizes: tuple[int, ...] = (4, 5)
    bits: int = 18
    #: The chain is fitted on so many rows of each combination of labels at most; class shares and
    #: predictions cover every row.
    rows_per_combination: int = 1500
    folds: int = 5
    threshold: float = 0.5
    #: Standard errors by which an n-gram's share must differ between the classes to be a feature.
    least_z: float = 2.5
    ftrl: Ftrl = field(default_factory=lambda: Ftrl(alpha=0.1, l1=0.1, l2=0.1, epochs=4))


def logistic(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -500.0, 500.0))))


@dataclass(frozen=True)
class Link:
    """One category's model: the buckets with a weight, weights of the earlier categories, shift to
    the share of the category among all labelled rows."""

    at: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float
    shift: float = 0.0

    def raw(self, flags: np.ndarray, earlier: Sequence[float] | np.ndarray) -> float:
        return float(flags[self.at] @ self.weights) + float(np.dot(self.earlier, earlier)) + self.intercept


@dataclass(frozen=True)
class Model:
    params: Params
    links: tuple[Link, ...]

    def predict(self, text: str | None, flags: np.ndarray) -> list[float]:
        """A probability for each category of the chain. `flags` is scratch space of 2**bits zeros."""
        if not self.links or not ngrams.has_letter(text):
            return [0.0] * len(self.params.chain)
        parts = list(ngrams.buckets(text, self.params.sizes, self.params.bits))
        for block in parts:
            flags[block] = 1
        inputs: list[float] = []
        out: list[float] = []
        for link in self.links:
            logit = link.raw(flags, inputs)
            inputs.append(logistic(logit))
            out.append(logistic(logit + link.shift))
        for block in parts:
            flags[block] = 0
        return out


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text") -> Model:
    """Learns the chain from the labelled documents.

    Rows with a NULL label, key or text are left out; of conflicting labels for a key the largest
    counts. Without labelled rows the model gives probability 0 to everything.
    """
    named = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        *[F.max(c).cast("int").alias(f"y{k}") for k, c in enumerate(params.chain)]
    )
    targets = [f"y{k}" for k in range(len(params.chain))]
    named = named.dropna(subset=targets).where(" AND ".join(f"{y} IN (0, 1)" for y in targets))
    keyed = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    known = keyed.select("key").join(named, "key")
    shares = {tuple(r[:-1]): r[-1] for r in known.groupBy(*targets).count().collect()}  # 2**categories rows
    drawn = draw(known, "key", targets, params.rows_per_combination)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << params.bits, np.uint8)
        for batch in batches:
            at = [
                ngrams.present(t.as_py(), params.sizes, params.bits, flags).astype("<u4").tobytes()
                for t in batch.column(batch.num_columns - 1)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(at, pa.binary())], [*batch.schema.names[:-1], "at"])

    columns = ["place", *targets]
    # Bounded by rows_per_combination: the drawn keys go to the texts, and one task learns from all.
    chosen = keyed.join(F.broadcast(drawn.dropDuplicates(["key"])), "key").select(*columns, "text")
    kinds = f"place int, {', '.join(f'{y} int' for y in targets)}, at binary"
    sample = map_batches(chosen, featurise, kinds).repartition(1)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        for link, y in fit_chain(sorted(rows), params):
            columns = {"at": link.at, "weights": link.weights, "earlier": link.earlier}
            arrays = {n: [c.tobytes()] for n, c in columns.items()}
            yield pa.RecordBatch.from_pydict(
                arrays | {"intercept": [link.intercept], "zeros": [int((y == 0).sum())], "ones": [int(y.sum())]}
            )

    found = map_batches(
        sample, learn, "at binary, weights binary, earlier binary, intercept double, zeros long, ones long"
    ).collect()  # a row for each category
    return Model(
        params,
        tuple(
            Link(
                np.frombuffer(r.at, "<i8"),
                np.frombuffer(r.weights, "<f8"),
                np.frombuffer(r.earlier, "<f8"),
                r.intercept,
                shift_of(r.zeros, r.ones, shares, k),
            )
            for k, r in enumerate(found)
        ),
    )


def fit_chain(rows: list[tuple], params: Params) -> Iterator[tuple[Link, np.ndarray]]:
    """A link for each category, with the labels it was fitted on, from rows (place, labels of the
    chain, packed buckets)."""
    if not rows:
        return
    index = [np.frombuffer(r[-1], "<u4") for r in rows]
    fold = np.array([r[0] % params.folds for r in rows])
    earlier = np.zeros((len(rows), 0))
    for k in range(len(params.chain)):
        y = np.array([r[1 + k] for r in rows])
        yield fit_link(index, earlier, y, np.arange(len(y)), params), y
        if k + 1 < len(params.chain):
            # Later categories learn from what this one says of rows it has not seen.
            said = np.zeros(len(y))
            flags = np.zeros(1 << params.bits, np.uint8)
            for f in range(params.folds):
                link = fit_link(index, earlier, y, np.flatnonzero(fold != f), params)
                for i in np.flatnonzero(fold == f):
                    flags[index[i]] = 1
                    said[i] = logistic(link.raw(flags, earlier[i]))
                    flags[index[i]] = 0
            earlier = np.column_stack([earlier, said])


def ratios(index: list[np.ndarray], y: np.ndarray, rows: np.ndarray, params: Params) -> np.ndarray:
    """For each bucket the log ratio of its shares in both classes, 0 if the shares hardly differ."""
    held = np.zeros((2, 1 << params.bits))
    for i in rows:
        held[y[i], index[i]] += 1
    n = np.bincount(y[rows], minlength=2)[:, None]
    share = (held + 1) / (n + 2)
    joint = (held.sum(axis=0) + 1) / (n.sum() + 2)
    error = np.sqrt(joint * (1 - joint) * (1 / np.maximum(n, 1)).sum())
    z = np.abs(held[1] / max(n[1, 0], 1) - held[0] / max(n[0, 0], 1)) / error
    return np.where(z >= params.least_z, np.log(share[1]) - np.log(share[0]), 0.0)


def fit_link(index: list[np.ndarray], earlier: np.ndarray, y: np.ndarray, rows: np.ndarray, params: Params) -> Link:
    """A linear model on the telling n-grams, each scaled by its log ratio, and on the probabilities
    of the earlier categories."""
    scale, k = ratios(index, y, rows, params), earlier.shape[1]
    kept = np.flatnonzero(scale)
    place = np.full(len(scale), -1)
    place[kept] = np.arange(len(kept))
    scale = scale[kept]
    given: list[Row] = []
    for i in rows:
        at = place[index[i]]
        at = at[at >= 0]
        given.append((np.append(at, len(kept) + np.arange(k)), np.append(scale[at], earlier[i]), int(y[i])))
    weights = params.ftrl.fit(given, len(kept) + k, 2)
    w = weights[:, 1] - weights[:, 0]
    scaled = w[: len(kept)] * scale
    used = scaled != 0
    return Link(kept[used], scaled[used], w[len(kept) : -1].copy(), float(w[-1]))


def shift_of(zeros: int, ones: int, shares: dict[tuple, int], k: int) -> float:
    """From the share of category k in the sample to that among all labelled rows, as log odds."""
    all_ones = sum(n for combo, n in shares.items() if combo[k])
    all_zeros = sum(shares.values()) - all_ones
    return float(np.log((all_ones + 1) / (all_zeros + 1)) - np.log((ones + 1) / (zeros + 1)))


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document its key, a column p_<category> for each category, and `toxic`: whether the
    last category's probability reaches the threshold. Map-only; whole texts. NULL and empty texts
    and those without a letter have probability 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the weights that are not zero
    chain, bits, least = model.params.chain, model.params.bits, model.params.threshold
    kind = docs.schema[key].dataType.simpleString()
    names = [f"p{k}" for k in range(len(chain))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = remembered(f"toxicity {bits}", lambda: np.zeros(1 << bits, np.uint8))
        for batch in batches:
            p = [shared.value.predict(t.as_py(), flags) for t in batch.column(1)]
            own = [pa.array([x[k] for x in p], pa.float64()) for k in range(len(chain))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *own, pa.array([x[-1] >= least for x in p], pa.bool_())], ["key", *names, "toxic"]
            )

    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = map_batches(given, run, f"key {kind}, {', '.join(f'{n} double' for n in names)}, toxic boolean")
    return found.select(
        F.col("key").alias(key), *[F.col(n).alias(f"p_{c}") for n, c in zip(names, chain, strict=True)], "toxic"
    )


def keep(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents, all columns, that are not toxic. A NULL or empty text, or one without a letter,
    has probability 0 and stays."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, bits, least = docs.columns.index(text), model.params.bits, model.params.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = remembered(f"toxicity {bits}", lambda: np.zeros(1 << bits, np.uint8))
        for batch in batches:
            yield batch.filter(
                pa.array([shared.value.predict(t.as_py(), flags)[-1] < least for t in batch.column(at)], pa.bool_())
            )

    return map_batches(docs, run, docs.schema)
