"""Language model scores: a gated recurrent network with a class-factored output, and a unigram base."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from article_warehouse.files import delete_folder
from article_warehouse.llm.common import flat_bytes, id_remainder, new_folder, pieces, stored, text_of
from article_warehouse.llm.words import LOWER, NOT_BLANK, Places, hashed_words, mixed

# Classes of frequent words, words in each, and classes that all other words are in by how they end.
CLASSES, WORDS, TAILS, HIDDEN = 32, 32, 32, 16
KNOWN = CLASSES * WORDS
# Tokens whose counts each task has at hand, at most; the counts of the rest are joined.
FREQUENT = 1 << 16
# Training: tokens that a copy learns from in a round, about, windows and lanes of a step.
STREAM_TOKENS, WINDOW, LANES, RATE = 1 << 19, 32, 128, 0.014
# Tokens that a task holds counts of before it passes them on, and pieces of text that are added to them together.
HELD_COUNTS, TOGETHER = 1 << 20, 16
# Bytes of text whose documents go forward together, steps of a window, rows of the output layer at a time.
TOGETHER_BYTES, STEPS, OUTPUT_ROWS = 12 << 20, 64, 1 << 15

_TAIL_MASK = np.uint64(TAILS - 1)
# The end of a text is a token of its own; no word has its tail class and hash but by chance.
END = mixed(np.array([3], np.uint64))[0] & ~_TAIL_MASK


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts, each text with its end, and where each text's tokens begin.

    A token is a 59-bit hash of the word and, in the lowest bits, its tail class, which its last two bytes give.
    """
    flat, offsets = flat_bytes(texts)
    hashes, starts, ends, before = hashed_words(flat, offsets, NOT_BLANK)
    last = LOWER[flat[ends - 1]].astype(np.uint64) if len(ends) else hashes
    second = np.where(ends - starts > 1, LOWER[flat[ends - 2]], 0).astype(np.uint64) if len(ends) else hashes
    tail = mixed(last << np.uint64(8) | second) >> np.uint64(59)
    words = (hashes & ~_TAIL_MASK) | tail
    begins = before + np.arange(len(before))
    tokens = np.full(begins[-1], END, np.uint64)
    inner = np.ones(begins[-1], bool)
    inner[begins[1:] - 1] = False
    tokens[inner] = words
    return tokens, begins


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of tokens, added up over a task up to ``HELD_COUNTS`` at a time."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def result() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["token", "n"])

    def added() -> tuple[np.ndarray, np.ndarray]:
        parts = [(keys, counts), *waiting]
        waiting.clear()
        both, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return both, np.bincount(place, np.concatenate([n for _, n in parts]), len(both)).astype(np.int64)

    for batch in batches:
        for piece in pieces(batch.column(0)):
            waiting.append(np.unique(tokens_of(piece)[0], return_counts=True))
            if len(waiting) == TOGETHER or sum(len(k) for k, _ in waiting) > HELD_COUNTS:
                keys, counts = added()
                if len(keys) > HELD_COUNTS:
                    yield result()
                    keys, counts = keys[:0], counts[:0]
    keys, counts = added()
    yield result()


@dataclass
class Vocabulary:
    """Counts of the frequent tokens, most frequent first, and what the probabilities need of all.

    The first ``KNOWN`` tokens are words of the network. ``total`` and ``distinct`` are of all tokens,
    ``tail_total`` and ``tail_distinct`` of those that are no words of the network, by tail class.
    """

    tokens: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int
    tail_total: np.ndarray
    tail_distinct: np.ndarray

    def parts(self) -> tuple:
        """What a vocabulary is made of, for a broadcast: its class may be unknown where that is read."""
        return self.tokens, self.counts, self.total, self.distinct, self.tail_total, self.tail_distinct

    def numbers(self, tokens: np.ndarray, places: Places) -> tuple[np.ndarray, np.ndarray]:
        """Input number of each token (word of the network, or tail class) and its place in the counts, -1 if not there."""
        place = places.find(tokens)
        known = (place >= 0) & (place < KNOWN)
        return np.where(known, place, KNOWN + (tokens & _TAIL_MASK).astype(np.int32)).astype(np.int32), place

    @property
    def base_divisor(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    @property
    def tail_divisors(self) -> np.ndarray:
        return self.tail_total + 0.5 * (self.tail_distinct + 1)


def token_counts(docs: DataFrame) -> DataFrame:
    """How often each token occurs in ``docs``: token, n."""
    found = docs.select(text_of().alias("text")).mapInArrow(_counted, "token long, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def learned_vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """The vocabulary, and the least count of its tokens."""
    # Steps of a quarter of a power of two: at most 256 rows.
    step = F.floor(4 * F.log2("n")).alias("step")
    steps = sorted(counts.groupBy(step).agg(F.count(F.lit(1)).alias("tokens"), F.sum("n").alias("n")).collect(), reverse=True)
    least, taken = 1 << 62, 0
    for row in steps:
        if taken + row.tokens > FREQUENT:
            break
        least, taken = math.ceil(2 ** (row.step / 4) - 1e-9), taken + row.tokens
    # Counts in a step begin at the least whole number in it.
    table = counts.where(F.col("n") >= least).toArrow()
    tokens, n = np.asarray(table["token"]).view(np.uint64), np.asarray(table["n"])
    order = np.lexsort([tokens, -n])
    tokens, n = tokens[order].copy(), n[order].copy()
    tails = counts.groupBy(F.col("token").bitwiseAND(TAILS - 1).alias("tail")).agg(F.count(F.lit(1)).alias("tokens"), F.sum("n").alias("n"))
    total, distinct = np.zeros(TAILS), np.zeros(TAILS)
    for row in tails.collect():
        total[row.tail], distinct[row.tail] = row.n, row.tokens
    all_total, all_distinct = int(total.sum()), int(distinct.sum())
    own = (tokens[:KNOWN] & _TAIL_MASK).astype(np.int64)
    total -= np.bincount(own, n[:KNOWN], TAILS)
    distinct -= np.bincount(own, minlength=TAILS)
    return Vocabulary(tokens, n, all_total, all_distinct, total, distinct), least


Weights = dict[str, np.ndarray]


def first_weights(vocabulary: Vocabulary) -> Weights:
    """Small random weights; the output starts as the frequencies of classes and of words in their classes."""
    rng = np.random.default_rng(11)
    counts = np.zeros(KNOWN)
    counts[: min(KNOWN, len(vocabulary.counts))] = vocabulary.counts[:KNOWN]
    counts = counts.reshape(CLASSES, WORDS)
    by_class = np.concatenate([counts.sum(axis=1), vocabulary.tail_total]) + 0.5
    weights = {
        "input": rng.normal(0, 0.1, (KNOWN + TAILS, 3 * HIDDEN)),
        "state": rng.normal(0, 0.25, (HIDDEN, 3 * HIDDEN)),
        "class": rng.normal(0, 0.1, (HIDDEN, CLASSES + TAILS)),
        "class_bias": np.log(by_class / by_class.sum()),
        "word": rng.normal(0, 0.1, (CLASSES, HIDDEN, WORDS)),
        "word_bias": np.log((counts + 1e-3) / (counts + 1e-3).sum(axis=1, keepdims=True)),
    }
    # Classes without words are never a target.
    return {name: values.astype(np.float32) for name, values in weights.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(1) / (np.float32(1) + np.exp(-x))


def _step(weights: Weights, numbers: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, tuple]:
    """One step of the gated recurrent unit: update gate, reset gate, candidate."""
    given, own = weights["input"][numbers], state @ weights["state"]
    gates = _sigmoid(given[:, : 2 * HIDDEN] + own[:, : 2 * HIDDEN])
    keep, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
    candidate = np.tanh(given[:, 2 * HIDDEN :] + reset * own[:, 2 * HIDDEN :])
    return candidate + keep * (state - candidate), (keep, reset, candidate, own[:, 2 * HIDDEN :])


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def class_of(numbers: np.ndarray) -> np.ndarray:
    return np.where(numbers < KNOWN, numbers // WORDS, numbers - KNOWN + CLASSES)


def _by_class(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of the words of the network by their class."""
    rows = np.flatnonzero(numbers < KNOWN)
    classes = numbers[rows] // WORDS
    order = np.argsort(classes, kind="stable")
    bounds = np.searchsorted(classes[order], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        if bounds[c] < bounds[c + 1]:
            yield c, rows[order[bounds[c] : bounds[c + 1]]]


def log_probabilities(weights: Weights, states: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Natural log of P(class | state), and for words of the network times P(word | class, state)."""
    found = np.empty(len(numbers), np.float64)
    for at in range(0, len(numbers), OUTPUT_ROWS):
        some, of = states[at : at + OUTPUT_ROWS], numbers[at : at + OUTPUT_ROWS]
        logs = _log_softmax(some @ weights["class"] + weights["class_bias"])
        part = logs[np.arange(len(of)), class_of(of)].astype(np.float64)
        for c, rows in _by_class(of):
            inner = _log_softmax(some[rows] @ weights["word"][c] + weights["word_bias"][c])
            part[rows] += inner[np.arange(len(rows)), of[rows] % WORDS]
        found[at : at + OUTPUT_ROWS] = part
    return found


def trained(weights: Weights, stream: np.ndarray, end: int) -> Weights:
    """Weights after one pass over ``stream``, token numbers in which each text closes with ``end``.

    Truncated backpropagation: the stream is cut into lanes, which go forward by windows; the state is carried
    from window to window, gradients are not. The state begins anew with each text. Adam with clipped gradients.
    """
    weights = {name: values.copy() for name, values in weights.items()}
    lanes = max(1, min(LANES, len(stream) // WINDOW))
    length = -(-len(stream) // lanes)
    # The last lanes are filled up; what fills them has no slope.
    filled = np.concatenate([stream, np.full(lanes * length - len(stream), end, stream.dtype)])
    targets = filled.reshape(lanes, length).T
    real = (np.arange(len(filled)) < len(stream)).reshape(lanes, length).T
    inputs = np.concatenate([np.full((1, lanes), end, stream.dtype), targets[:-1]])
    mean = {name: np.zeros_like(v) for name, v in weights.items()}
    square = {name: np.zeros_like(v) for name, v in weights.items()}
    state, done = np.zeros((lanes, HIDDEN), np.float32), 0
    for at in range(0, length, WINDOW):
        window = slice(at, at + WINDOW)
        if not real[window].any():
            break
        grads, state = _window_gradients(weights, inputs[window], targets[window], state, end, real[window])
        done += 1
        size = math.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()))
        scale = np.float32(min(1.0, 1.0 / max(size, 1e-9)))
        for name, grad in grads.items():
            grad *= scale
            mean[name] += np.float32(0.1) * (grad - mean[name])
            square[name] += np.float32(0.005) * (grad * grad - square[name])
            rate = RATE * math.sqrt(1 - 0.995**done) / (1 - 0.9**done)
            weights[name] -= np.float32(rate) * mean[name] / (np.sqrt(square[name]) + np.float32(1e-8))
    return weights


def _window_gradients(
    weights: Weights, inputs: np.ndarray, targets: np.ndarray, state: np.ndarray, end: int, real: np.ndarray | None = None
) -> tuple[Weights, np.ndarray]:
    """Gradients of the mean loss over the targets (those that are ``real``), and the state after the window."""
    steps, lanes = inputs.shape
    kind = state.dtype
    alive = (inputs != end)[:, :, None].astype(kind)
    given = weights["input"][inputs]
    states, before = np.empty((steps, lanes, HIDDEN), kind), np.empty((steps, lanes, HIDDEN), kind)
    gates, candidates, owns = np.empty((steps, lanes, 2 * HIDDEN), kind), np.empty_like(states), np.empty_like(states)
    for t in range(steps):
        state = np.multiply(state, alive[t], out=before[t])
        own = state @ weights["state"]
        owns[t] = own[:, 2 * HIDDEN :]
        both = np.add(given[t, :, : 2 * HIDDEN], own[:, : 2 * HIDDEN], out=gates[t])
        np.negative(both, out=both)
        np.exp(both, out=both)
        both += 1
        np.reciprocal(both, out=both)
        candidate = np.multiply(both[:, HIDDEN:], owns[t], out=candidates[t])
        candidate += given[t, :, 2 * HIDDEN :]
        np.tanh(candidate, out=candidate)
        moved = np.subtract(state, candidate, out=states[t])
        moved *= both[:, :HIDDEN]
        moved += candidate
        state = moved
    flat, wanted = states.reshape(-1, HIDDEN), targets.ravel()
    counted = None if real is None or real.all() else real.ravel()
    part = kind.type(1 / (len(wanted) if counted is None else counted.sum()))
    grads = {name: np.zeros_like(v) for name, v in weights.items()}
    # Output layer: the slope of the mean loss.
    slope = _softmax(flat @ weights["class"] + weights["class_bias"])
    slope[np.arange(len(wanted)), class_of(wanted)] -= 1
    slope *= part
    if counted is not None:
        slope *= counted[:, None]
    grads["class"], grads["class_bias"] = flat.T @ slope, slope.sum(axis=0)
    back = slope @ weights["class"].T
    for c, rows in _by_class(wanted):
        some = flat[rows]
        inner = _softmax(some @ weights["word"][c] + weights["word_bias"][c])
        inner[np.arange(len(rows)), wanted[rows] % WORDS] -= 1
        inner *= part
        if counted is not None:
            inner *= counted[rows, None]
        grads["word"][c], grads["word_bias"][c] = some.T @ inner, inner.sum(axis=0)
        back[rows] += inner @ weights["word"][c].T
    back = back.reshape(steps, lanes, HIDDEN)
    # Through time, within the window.
    keep, reset = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:]
    to_candidate = (1 - keep) * (1 - candidates * candidates)
    to_keep = (before - candidates) * keep * (1 - keep)
    to_reset = owns * reset * (1 - reset)
    kept, stay, turned = keep * alive, np.ascontiguousarray(reset), np.ascontiguousarray(weights["state"].T)
    gate_slopes, through = np.empty((steps, lanes, 3 * HIDDEN), kind), np.empty((steps, lanes, 3 * HIDDEN), kind)
    later = np.zeros((lanes, HIDDEN), kind)
    for t in range(steps - 1, -1, -1):
        total, slopes, onward = back[t] + later, gate_slopes[t], through[t]
        of_candidate = np.multiply(total, to_candidate[t], out=slopes[:, 2 * HIDDEN :])
        np.multiply(total, to_keep[t], out=slopes[:, :HIDDEN])
        np.multiply(of_candidate, to_reset[t], out=slopes[:, HIDDEN : 2 * HIDDEN])
        onward[:, : 2 * HIDDEN] = slopes[:, : 2 * HIDDEN]
        np.multiply(of_candidate, stay[t], out=onward[:, 2 * HIDDEN :])
        later = onward @ turned
        later *= alive[t]
        total *= kept[t]
        later += total
    grads["state"] = before.reshape(-1, HIDDEN).T @ through.reshape(-1, 3 * HIDDEN)
    # The slopes of each input number, added up.
    numbers = inputs.ravel()
    order = np.argsort(numbers, kind="stable")
    found, starts = np.unique(numbers[order], return_index=True)
    grads["input"][found] = np.add.reduceat(gate_slopes.reshape(-1, 3 * HIDDEN)[order], starts, axis=0)
    return grads, state


def document_logs(weights: Weights, numbers: np.ndarray, begins: np.ndarray, end: int) -> np.ndarray:
    """Natural log of the probability that the network gives to each text's classes and words.

    All texts go forward together, the longest first, by windows of ``STEPS``; states are carried from window to window.
    """
    lengths = np.diff(begins)
    order = np.argsort(-lengths, kind="stable")
    lengths, starts = lengths[order], begins[:-1][order]
    found, state = np.zeros(len(order)), np.zeros((len(order), HIDDEN), np.float32)
    for at in range(0, int(lengths[0]) if len(order) else 0, STEPS):
        # Texts that have a token at step at + t come first, so each step takes a shorter prefix.
        going = len(order) - np.searchsorted(lengths[::-1], np.arange(at, at + STEPS), "right")
        going = going[going > 0]
        states = np.empty((int(going.sum()), HIDDEN), np.float32)
        targets, place = np.empty(len(states), np.int32), 0
        for t, count in enumerate(going.tolist()):
            here = starts[:count] + at + t
            inputs = numbers[here - 1] if at + t else np.full(count, end, np.int32)
            state[:count] = _step(weights, inputs, state[:count])[0]
            states[place : place + count], targets[place : place + count] = state[:count], numbers[here]
            place += count
        logs = log_probabilities(weights, states, targets)
        place = 0
        for count in going.tolist():
            found[:count] += logs[place : place + count]
            place += count
    result = np.empty(len(order))
    result[order] = found
    return result


def end_number(vocabulary: Vocabulary, places: Places) -> int:
    return int(vocabulary.numbers(np.array([END]), places)[0][0])


def training_streams(docs: DataFrame, vocabulary: Vocabulary) -> tuple[DataFrame, int, int]:
    """Streams of token numbers with every text of ``docs`` in one of them, the rounds, and the streams of a round.

    Columns: copy, stream (numbers of two bytes), round. The number of streams follows from the tokens, the rounds are
    its square root. A text goes by the hash of its numbers, and stands in its stream in that order. Texts with the same
    numbers are counted, and dealt out evenly from there on.
    """
    streams = max(1, round(vocabulary.total / STREAM_TOKENS))
    rounds = math.isqrt(streams)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.parts())

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*shared.value)
        places = Places(vocabulary.tokens)
        for batch in batches:
            for piece in pieces(batch.column(0)):
                tokens, begins = tokens_of(piece)
                data = vocabulary.numbers(tokens, places)[0].astype(np.int16).tobytes()
                offsets = pa.py_buffer((begins * 2).astype(np.int64).tobytes())
                texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(piece), [None, offsets, pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([texts.cast(pa.binary())], ["numbers"])

    def joined(table: pa.Table) -> pa.Table:
        texts, times = table["numbers"].to_pylist(), table["times"].to_pylist()
        order = sorted(range(len(texts)), key=list(zip(table["hash"].to_pylist(), texts, strict=True)).__getitem__)
        stream = b"".join(texts[i] * times[i] for i in order)
        return pa.table({"unit": table["unit"][:1], "stream": pa.array([stream], pa.binary())})

    alike = docs.select(text_of().alias("text")).mapInArrow(numbered, "numbers binary").groupBy("numbers").agg(F.count(F.lit(1)).alias("n"))
    # The k-th of n texts goes to the k-th stream from where the hash points.
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.least("n", F.lit(streams)) - 1)).alias("step")
    each = alike.select("numbers", "n", F.xxhash64("numbers").alias("hash"), step)
    times = F.expr(f"n div {streams}") + F.when(F.col("step") < F.col("n") % streams, 1).otherwise(0)
    unit = F.pmod(F.pmod("hash", F.lit(streams)) + F.col("step"), F.lit(streams))
    dealt = each.select("numbers", "hash", unit.alias("unit"), times.alias("times"))
    whole = dealt.groupBy("unit").applyInArrow(joined, "unit long, stream binary")
    kept = whole.select(F.expr(f"int(unit div {rounds})").alias("copy"), "stream", F.expr(f"int(unit % {rounds})").alias("round"))
    return kept.repartition("round", "copy"), rounds, -(-streams // rounds)


def fit_network(docs: DataFrame, vocabulary: Vocabulary) -> Weights:
    """Weights of the network, from every text of ``docs`` once.

    In each round copies of the network are trained on a stream each, and averaged by their tokens. Both the rounds and
    the copies of a round grow with the tokens; neither the copies nor their texts depend on the partitions of ``docs``.
    The averages are taken in two levels, so that with n copies no group has many more than the square root of n.
    """
    weights = first_weights(vocabulary)
    if not len(vocabulary.tokens):
        return weights
    spark, end = docs.sparkSession, end_number(vocabulary, Places(vocabulary.tokens))
    streams, rounds, copies = training_streams(docs, vocabulary)
    path = new_folder(spark)
    try:
        streams.write.partitionBy("round").parquet(path)
        return _rounds(spark, path, rounds, copies, weights, end)
    finally:
        delete_folder(spark, path)


def _rounds(spark: SparkSession, path: str, rounds: int, copies: int, weights: Weights, end: int) -> Weights:
    """The weights after all rounds over the streams stored at ``path``."""
    shapes = {name: values.shape for name, values in weights.items()}
    groups, schema = math.isqrt(copies), "part int, tokens long, weights binary"

    def row(part: int, tokens: int, weights: bytes) -> dict[str, pa.Array]:
        return {"part": pa.array([part], pa.int32()), "tokens": pa.array([tokens], pa.int64()), "weights": pa.array([weights], pa.binary())}

    def average(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table["part"]))
        tokens, parts = np.asarray(table["tokens"]), table["weights"].to_pylist()
        mean = sum(np.frombuffer(parts[i], np.float32) * (float(tokens[i]) / tokens.sum()) for i in order).astype(np.float32)
        return pa.table(row(int(table["part"][int(order[0])].as_py()), int(tokens.sum()), mean.tobytes()))

    for number in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def train(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for copy, stream in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    numbers = np.frombuffer(stream.as_buffer(), np.int16).astype(np.int32)
                    after = trained(shared.value, numbers, end)
                    yield pa.RecordBatch.from_pydict(row(copy, len(numbers), np.concatenate([v.ravel() for v in after.values()]).tobytes()))

        own = spark.read.schema("copy int, stream binary").parquet(f"{path}/round={number}")
        after = own.repartitionById(copies, F.col("copy")).mapInArrow(train, schema)
        some = after.groupBy(F.pmod("part", F.lit(groups))).applyInArrow(average, schema).toArrow()
        flat, start = np.frombuffer(average(some)["weights"][0].as_py(), np.float32), 0
        for name, shape in shapes.items():
            weights[name] = flat[start : start + math.prod(shape)].reshape(shape)
            start += math.prod(shape)
        shared.unpersist()
    return weights


def scored_texts(texts: pa.Array, weights: Weights, vocabulary: Vocabulary, places: Places) -> pa.StructArray:
    """Of each text: tokens, frequent ones, their part of both scores, and the tokens that are not frequent.

    Probabilities of the other tokens lack only their log10(count + 0.5) in both scores.
    """
    parts = [tokens_of(piece) for piece in pieces(texts)]
    tokens = np.concatenate([t for t, _ in parts]) if parts else np.zeros(0, np.uint64)
    lengths = np.concatenate([np.diff(b) for _, b in parts]) if parts else np.zeros(0, np.int64)
    begins = np.concatenate(([0], np.cumsum(lengths)))
    numbers, place = vocabulary.numbers(tokens, places)
    end = end_number(vocabulary, places)
    owner = np.repeat(np.arange(len(texts)), lengths)
    frequent = place >= 0
    count_logs = np.zeros(len(tokens))
    count_logs[frequent] = np.log10(vocabulary.counts[place[frequent]] + 0.5)
    size = len(texts)
    base = np.bincount(owner, count_logs, size) - lengths * math.log10(vocabulary.base_divisor)
    of_tail = numbers >= KNOWN
    inside = np.where(of_tail, count_logs - np.log10(vocabulary.tail_divisors)[np.maximum(numbers - KNOWN, 0)], 0)
    score = document_logs(weights, numbers, begins, end) / math.log(10) + np.bincount(owner, inside, size)
    rest = np.flatnonzero(~frequent)
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owner[rest], minlength=size)))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens[rest].view(np.int64)))
    columns = [pa.array(lengths), pa.array(np.bincount(owner[frequent], minlength=size)), pa.array(base), pa.array(score), lists]
    return pa.StructArray.from_arrays(columns, ["n_tokens", "n_known", "base", "score", "rest"])


def language_model_scores(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from documents that are not held out (``id_remainder(5)`` is 1 for those): counts of tokens from all of
    them, the network from each of them once. ``base_score`` is the log10 probability by smoothed
    frequencies, ``score`` that of the whole text by the network: P(class) P(word | class) for frequent words, and
    P(class) times the smoothed share of the word in its class for all others. Null and empty texts are a
    single end. Tokens are told apart by 59-bit hashes and their last bytes, so texts of a corpus with a
    billion distinct words would hold a mistaken count with a chance of about a half.
    """
    learned = docs.where(id_remainder(5) != 1)
    counts = stored(token_counts(learned))
    vocabulary, least = learned_vocabulary(counts)
    weights = fit_network(learned, vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((weights, vocabulary.parts()))

    @F.arrow_udf("struct<n_tokens: long, n_known: long, base: double, score: double, rest: array<long>>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, vocabulary = shared.value[0], Vocabulary(*shared.value[1])
        places = Places(vocabulary.tokens)
        for texts in batches:
            parts = [scored_texts(part, weights, vocabulary, places) for part in pieces(texts, TOGETHER_BYTES)]
            yield pa.concat_arrays(parts) if parts else scored_texts(texts, weights, vocabulary, places)

    rows = docs.select("doc_id", (id_remainder(5) == 1).alias("held_out"), scored(text_of()).alias("found"))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "held_out", "found.*"))
    rare = counts.where(F.col("n") < least)
    logs = (
        rows.select("row_id", F.explode("rest").alias("token"))
        .join(rare, "token", "left")
        .groupBy("row_id")
        .agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"), F.count("n").alias("known"))
    )
    more = F.coalesce("logs", F.lit(0.0))
    return rows.join(logs, "row_id", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
