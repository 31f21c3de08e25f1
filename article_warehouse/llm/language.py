"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from article_warehouse.llm.common import id_remainder, kept_in_worker, pieces, text_of

# N-grams of a profile, and their longest length.
PROFILE, LONGEST = 300, 3
UNKNOWN = "und"
# Counters that a table of all n-grams over the characters of a run may have.
TABLE_SIZE = 1 << 20
# Bytes of text in arrays at a time, some 50 bytes for each; a longer text is cut between words into runs of so many characters.
RUN_BYTES = 1 << 18
# N-grams that a task holds counts of before it passes them on.
HELD_GRAMS = 1 << 19

_BLANK = re.compile(r"\s")


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""

    def made() -> np.ndarray:
        points = np.arange(0x110000, dtype=np.uint32)
        points[0xD800:0xE000] = 32
        return np.char.isalpha(points.view("U1"))

    return kept_in_worker("letters", made)


def runs(text: str) -> list[str]:
    """``text`` cut at blanks into runs of about ``RUN_BYTES`` characters. The n-grams of the runs are those of the text,
    since none spans a blank."""
    found, start = [], 0
    while len(text) - start > RUN_BYTES:
        blank = _BLANK.search(text, start + RUN_BYTES)
        if not blank:
            break
        found.append(text[start : blank.start()])
        start = blank.end()
    return [*found, text[start:]]


def letter_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts in lower case, with one 0 for each run of others, and where each text begins.

    Each text begins and ends with a 0.
    """
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    lengths = np.asarray(pc.utf8_length(lowered)).astype(np.int64)
    joined = "\n".join(["", *lowered.to_pylist(), ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))
    kept[begins] = True
    stream = np.where(letter, points, 0)[kept].astype(np.int64)
    return stream, np.cumsum(kept)[begins] - 1


def gram_keys(stream: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length the n-grams that begin at each place, as distinct numbers, and which of them count.

    An n-gram stays within a word and the blank on either side of it.
    """
    real = stream != 0
    a, b, c = stream, stream[1:], stream[2:]
    inner = real[1:-1] if len(stream) > 2 else np.zeros(0, bool)
    return [
        (a | 1 << 62, real),
        (a[:-1] << 21 | b | 1 << 61, real[:-1] | real[1:]),
        (a[:-2] << 42 | b[:-1] << 21 | c if len(stream) > 2 else stream[:0], inner),
    ]


def ranked(keys: np.ndarray) -> np.ndarray:
    """The most frequent of ``keys``, ties by their number."""
    return most_frequent(*np.unique(keys, return_counts=True))


def most_frequent(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The keys with the highest counts, ties by their number; ``keys`` rise."""
    return keys[np.argsort(-counts, kind="stable")[:PROFILE]]


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by key added up, keys rising."""
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([c for _, c in parts])).astype(np.int64)


def counted(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram of a stream and how often it occurs."""
    alphabet = np.flatnonzero(np.bincount(stream)) if len(stream) else stream
    size = len(alphabet)
    if size**LONGEST > TABLE_SIZE:
        return np.unique(np.concatenate([keys[real] for keys, real in gram_keys(stream)]), return_counts=True)
    number = np.zeros(int(alphabet[-1]) + 1 if size else 1, np.int64)
    number[alphabet] = np.arange(size)
    small, real = number[stream], stream != 0
    ones = np.bincount(small[real], minlength=size)
    twos = np.bincount((small[:-1] * size + small[1:])[real[:-1] | real[1:]], minlength=size**2)
    inner = real[1:-1]
    threes = np.bincount((small[:-2] * size**2 + small[1:-1] * size + small[2:])[inner] if len(stream) > 2 else small[:0], minlength=size**3)
    keys, counts = [], []
    for length, table in ((1, ones), (2, twos), (3, threes)):
        used = np.flatnonzero(table)
        digits = [alphabet[used // size**power % size] for power in range(length)]
        keys.append(sum(digit << 21 * power for power, digit in enumerate(digits)) | (0, 1 << 62, 1 << 61, 0)[length])
        counts.append(table[used])
    return np.concatenate(keys), np.concatenate(counts)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams per language (text, lang), added up over a task up to ``HELD_GRAMS`` at a time."""
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def results() -> Iterator[pa.RecordBatch]:
        for lang, (keys, counts) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], ["lang", "gram", "n"])
        total.clear()

    for batch in batches:
        for lang in pc.unique(batch.column(1)).to_pylist():
            for piece in pieces(batch.column(0).filter(pc.equal(batch.column(1), lang)), RUN_BYTES):
                # A piece of more than one text is short.
                cut = [pa.array([run]) for run in runs(piece[0].as_py())] if len(piece) == 1 else [piece]
                for part in cut:
                    found = counted(letter_stream(part)[0])
                    total[lang] = merged([total[lang], found]) if lang in total else merged([found])
                    if sum(len(keys) for keys, _ in total.values()) > HELD_GRAMS:
                        yield from results()
    yield from results()


def language_profiles(docs: DataFrame) -> dict[str, list[int]]:
    """Of each language its ``PROFILE`` most frequent n-grams, over all documents that are not held out."""
    learned = docs.where(F.col("lang").isNotNull() & (id_remainder(4) != 2))
    rows = learned.select(text_of().alias("text"), F.col("lang").cast("string").alias("lang"))
    totals = rows.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    # A profile's length of rows for each language.
    first = totals.withColumn("place", place).where(F.col("place") <= PROFILE).collect()
    profiles: dict[str, list[int]] = {}
    for row in sorted(first, key=lambda r: (r.lang, r.place)):
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from text and ``lang`` of the documents that are not held out (``id_remainder(4)`` is 2 for those).
    The language is the one whose profile is nearest to the n-grams of the text by the sum of rank differences; an n-gram
    that a profile lacks counts as a whole profile. Ties go to the first language by name. ``und`` with score 0 for a null
    text, one without a letter, and where no language was learned. The score is 1 less the distance over the greatest one.
    """
    profiles = language_profiles(docs)
    names = sorted(profiles)
    known = np.unique(np.array([gram for name in names for gram in profiles[name]], np.int64))
    # Row of each n-gram of any profile, column of each language.
    places = np.full((len(known), len(names)), -1, np.int64)
    for column, name in enumerate(names):
        places[np.searchsorted(known, np.array(profiles[name], np.int64)), column] = np.arange(len(profiles[name]))
    shared = docs.sparkSession.sparkContext.broadcast((names, known, places))

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, known, places = shared.value
        for texts in batches:
            langs, scores = [], []
            for piece in pieces(texts, RUN_BYTES):
                for own in own_ranks(piece):
                    name, score = nearest(own, names, known, places)
                    langs.append(name)
                    scores.append(score)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    rows = docs.select("doc_id", (id_remainder(4) == 2).alias("held_out"), predicted(F.col("text").cast("string")).alias("found"))
    return rows.select("doc_id", "held_out", "found.lang_pred", "found.score")


def own_ranks(piece: pa.Array) -> Iterator[np.ndarray]:
    """The most frequent n-grams of each text of a piece."""
    if len(piece) == 1 and len(cut := runs(piece[0].as_py() or "")) > 1:
        total = merged([counted(letter_stream(pa.array(cut[:1]))[0])])
        for run in cut[1:]:
            total = merged([total, counted(letter_stream(pa.array([run]))[0])])
        yield most_frequent(*total)
        return
    stream, begins = letter_stream(piece)
    grams = gram_keys(stream)
    for start, end in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        yield ranked(np.concatenate([k[start : end + 2 - n][r[start : end + 2 - n]] for n, (k, r) in enumerate(grams, 1)]))


def nearest(own: np.ndarray, names: list[str], known: np.ndarray, places: np.ndarray) -> tuple[str, float]:
    """Nearest language to the most frequent n-grams of a text, by out-of-place distance."""
    if not len(own) or not names:
        return UNKNOWN, 0.0
    row = np.minimum(np.searchsorted(known, own), len(known) - 1)
    at = np.where((known[row] == own)[:, None], places[row], -1)
    apart = np.where(at >= 0, np.abs(at - np.arange(len(own))[:, None]), PROFILE)
    distances = apart.sum(axis=0)
    best = int(np.argmin(distances))
    return names[best], 1.0 - float(distances[best]) / (PROFILE * len(own))
