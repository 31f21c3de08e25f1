"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from article_warehouse.llm.common import flat_bytes, id_remainder, pieces, text_of
from article_warehouse.llm.words import NOT_BLANK, hashed_words

# Hash buckets for words, length of the interaction vectors, bins of each statistic.
WORD_BUCKETS, FACTORS, BINS = 1 << 16, 8, 10
# Labelled rows that the model is fitted on at most.
FIT_ROWS = 12_000
EPOCHS, BATCH, RATE, DECAY, SEED = 6, 128, 0.08, 1e-4, 7

# Kinds of bytes that are counted for the structure statistics.
_KINDS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\v\f\r", "\n", ".,;:", "!?", "|", "#$%&*@^~+=<>_", "\"'()[]{}`-/\\")
_KIND = np.zeros(256, np.int64)
for _number, _members in enumerate(_KINDS, 1):
    _KIND[list(_members.encode())] = _number
_KIND[128:] = len(_KINDS) + 1
STATISTICS = len(_KINDS) + 1 + 5


@dataclass(frozen=True)
class Inputs:
    """Of several texts: word buckets of all, number of words of each, and statistics (texts x STATISTICS)."""

    buckets: np.ndarray
    counts: np.ndarray
    statistics: np.ndarray


def inputs_of(texts: pa.Array, sizes: np.ndarray) -> Inputs:
    """``sizes``: the metadata, a recorded number of characters per text, -1 if unknown."""
    flat, offsets = flat_bytes(texts)
    hashes, starts, ends, before = hashed_words(flat, offsets, NOT_BLANK)
    counts, lengths, n_bytes = np.diff(before), ends - starts, np.diff(offsets)
    owner = np.repeat(np.arange(len(texts)), n_bytes)
    kinds = np.bincount(owner * (len(_KINDS) + 2) + _KIND[flat], minlength=len(texts) * (len(_KINDS) + 2)).reshape(len(texts), -1)
    of_word = np.repeat(np.arange(len(texts)), counts)

    def repeated(lag: int) -> np.ndarray:
        same = (hashes[lag:] == hashes[:-lag]) & (of_word[lag:] == of_word[:-lag]) if len(hashes) > lag else np.zeros(0, bool)
        return np.bincount(of_word[lag:][same], minlength=len(texts)) / np.maximum(counts, 1)

    shares = kinds[:, 1:] / np.maximum(n_bytes, 1)[:, None]
    mean_length = np.bincount(of_word, lengths, minlength=len(texts)) / np.maximum(counts, 1)
    rest = [np.log1p(counts), mean_length, repeated(1), repeated(2), np.log1p(np.maximum(sizes, -0.5))]
    return Inputs((hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), counts, np.column_stack([shares, *rest]))


@dataclass
class Model:
    """Bias, first-order weights and interaction vectors: words first, then the bins of each statistic."""

    edges: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def features(self, inputs: Inputs) -> np.ndarray:
        """Feature number of the bin that each statistic falls in."""
        bins = np.stack([np.searchsorted(self.edges[s], inputs.statistics[:, s], "right") for s in range(STATISTICS)], axis=1)
        return WORD_BUCKETS + np.arange(STATISTICS) * (BINS + 1) + bins

    def raw(self, inputs: Inputs) -> np.ndarray:
        return _forward(self, inputs.buckets, inputs.counts, self.features(inputs))[0]

    def scores(self, inputs: Inputs) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(inputs), -30, 30)))


def _forward(model: Model, buckets: np.ndarray, counts: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value of each text; the sums of its vectors; the share of each word occurrence.

    The pairwise part is half of (sum of x v) squared less the sum of (x v) squared, per factor, so its
    cost is linear in the features. Each occurrence of a word weighs 1 / words, each bin weighs 1.
    """
    share = np.repeat(1 / np.maximum(counts, 1), counts).astype(np.float32)
    width = model.vectors.shape[1]
    linear, sums, squares = np.zeros(len(counts)), np.zeros((len(counts), width)), np.zeros((len(counts), width))
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        linear[full] = np.add.reduceat(model.weights[buckets] * share, starts)
        taken = model.vectors[buckets] * share[:, None]
        sums[full] = np.add.reduceat(taken, starts, axis=0)
        squares[full] = np.add.reduceat(taken * taken, starts, axis=0)
    of_bins = model.vectors[bins]
    sums += of_bins.sum(axis=1)
    squares += (of_bins * of_bins).sum(axis=1)
    linear += model.weights[bins].sum(axis=1)
    return model.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums, share


def fitted(inputs: Inputs, labels: np.ndarray) -> Model:
    """Adagrad on the logistic loss, in batches, in an order that a fixed seed gives."""
    rng = np.random.default_rng(SEED)
    edges = np.quantile(inputs.statistics, np.linspace(0, 1, BINS + 2)[1:-1], axis=0).T if len(labels) else np.zeros((STATISTICS, BINS))
    size = WORD_BUCKETS + STATISTICS * (BINS + 1)
    vectors = rng.normal(0, 0.05, (size, FACTORS)).astype(np.float32)
    share = labels.mean() if len(labels) else 0.5
    prior = np.clip(share, 1e-3, 1 - 1e-3)
    model = Model(edges, float(np.log(prior / (1 - prior))), np.zeros(size, np.float32), vectors)
    if not len(labels) or share in (0, 1):
        return model
    all_bins, begins = model.features(inputs), np.cumsum(inputs.counts) - inputs.counts
    seen_w, seen_v, seen_b = np.full(size, 1e-6, np.float32), np.full((size, FACTORS), 1e-6, np.float32), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            counts, bins = inputs.counts[rows], all_bins[rows]
            buckets = np.concatenate([inputs.buckets[b : b + n] for b, n in zip(begins[rows], counts, strict=True)])
            value, sums, x = _forward(model, buckets, counts, bins)
            slope = (1 / (1 + np.exp(-np.clip(value, -30, 30))) - labels[rows]) / len(rows)
            of_word = np.repeat(np.arange(len(rows)), counts)
            features = np.concatenate([buckets, bins.ravel()])
            texts = np.concatenate([of_word, np.repeat(np.arange(len(rows)), STATISTICS)])
            weight = np.concatenate([x, np.ones(bins.size, np.float32)])
            used, place = np.unique(features, return_inverse=True)
            pull = slope[texts] * weight
            own = np.bincount(place, pull, len(used)) + DECAY * model.weights[used]
            seen_w[used] += own**2
            model.weights[used] -= RATE * own / np.sqrt(seen_w[used])
            steps = pull[:, None] * (sums[texts] - model.vectors[features] * weight[:, None])
            grad = np.stack([np.bincount(place, steps[:, f], len(used)) for f in range(FACTORS)], axis=1) + DECAY * model.vectors[used]
            seen_v[used] += grad**2
            model.vectors[used] -= 0.3 * RATE * grad / np.sqrt(seen_v[used])
            seen_b += slope.sum() ** 2
            model.bias -= RATE * slope.sum() / np.sqrt(seen_b)
    return model


def recorded_size(docs: DataFrame) -> Column:
    """The metadata of a document: ``n_chars`` where the table has it and it is not null, else -1."""
    if "n_chars" not in docs.columns:
        return F.lit(-1.0)
    return F.coalesce(F.col("n_chars").try_cast("double"), F.lit(-1.0))


def fit_quality(docs: DataFrame, labels: DataFrame) -> Model:
    """The model for ``labels.quality``, fitted on up to ``FIT_ROWS`` labelled documents.

    Only ids whose remainder by ``id_remainder(4)`` is not 2 are used. The rows are those with the
    smallest hashes of their ids, one for each id. One task fits the model, on the rows in a fixed order, so that reruns agree; both
    its rows and the result are bounded.
    """
    usable = labels.where("quality in (0, 1)").where(id_remainder(4) != 2).select("doc_id", F.col("quality").cast("int").alias("quality"))
    chosen = usable.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    size = recorded_size(docs)
    rows = docs.select("doc_id", text_of().alias("text"), size.alias("size")).join(F.broadcast(chosen), "doc_id")
    # An id may have several rows; the one whose text has the smallest hash is used.
    rank = F.struct(F.xxhash64("text"), "text", "size")
    rows = rows.groupBy("doc_id").agg(*[F.min_by(name, rank).alias(name) for name in ("text", "size", "quality")])
    rows = rows.coalesce(1).sortWithinPartitions("doc_id")
    rows = rows.select("text", "size", "quality")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, wanted = [], []
        for batch in batches:
            start = 0
            for piece in pieces(batch.column(0)):
                sizes = np.asarray(batch.column(1).slice(start, len(piece)))
                parts.append(inputs_of(piece, sizes))
                start += len(piece)
            wanted.append(np.asarray(batch.column(2), np.float64))
        if not wanted:
            return
        joined = Inputs(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("buckets", "counts", "statistics")))
        model = fitted(joined, np.concatenate(wanted))
        arrays = [model.edges.astype(np.float64).tobytes(), np.float64(model.bias).tobytes(), model.weights.tobytes(), model.vectors.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([a], pa.binary()) for a in arrays], ["edges", "bias", "weights", "vectors"])

    found = rows.mapInArrow(fit, "edges binary, bias binary, weights binary, vectors binary").collect()
    if not found:
        return fitted(Inputs(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, STATISTICS))), np.zeros(0))
    row = found[0]
    return Model(
        np.frombuffer(row.edges).reshape(STATISTICS, BINS),
        float(np.frombuffer(row.bias)[0]),
        np.frombuffer(row.weights, np.float32),
        np.frombuffer(row.vectors, np.float32).reshape(-1, FACTORS),
    )


def quality_column(docs: DataFrame, model: Model) -> Column:
    """Score of the text of each document, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast((model.edges, model.bias, model.weights, model.vectors))

    @F.arrow_udf("double")
    def scored(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own = Model(*shared.value)
        for texts, sizes in batches:
            found, start = [np.zeros(0)], 0
            for piece in pieces(texts):
                found.append(own.scores(inputs_of(piece, np.asarray(sizes.slice(start, len(piece))))))
                start += len(piece)
            yield pa.array(np.concatenate(found), pa.float64())

    return scored(text_of(), recorded_size(docs))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score (likelihood of quality 1), predicted (score >= ``threshold``).

    ``labels`` (doc_id, quality) teaches from ids that are not held out. Inputs of a score are the text
    and the metadata of ``recorded_size``. Null and empty texts get the score of a text without words; without any label
    the score is that of an even chance. Labels other than 0 and 1 are left out, of several for one id the highest counts.
    """
    model = fit_quality(docs, labels)
    score = quality_column(docs, model).alias("score")
    rows = docs.select("doc_id", (id_remainder(4) == 2).alias("held_out"), score)
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents with a score of ``threshold`` or more, with all columns of ``docs``.

    A null text is scored as an empty one. Rows that repeat all stay or all go, and an empty table stays empty.
    """
    return docs.where(quality_column(docs, fit_quality(docs, labels)) >= threshold)
