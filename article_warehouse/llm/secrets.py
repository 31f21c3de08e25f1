"""Secret scans with one automaton for all rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from article_warehouse.llm.automaton import Automaton, compiled
from article_warehouse.llm.common import flat_bytes, pieces, text_of

# Below this number of pieces of text, each is stepped through alone.
FEW = 64


def assigned_value(match: bytes) -> bytes:
    """What stands behind the sign, the blanks and the quote of an assignment."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    value = match[at + 1 :].lstrip(b" ")
    return value[1:] if value[:1] in (b'"', b"'") else value


@dataclass(frozen=True)
class Rule:
    """Leftmost longest matches of ``pattern`` without overlaps, dropped if ``measured`` is under ``least`` long."""

    kind: str
    pattern: bytes
    least: int
    fold: bool = False
    measured: Callable[[bytes], bytes] = bytes


# The first three rules and their order.
BASE_RULES = (
    Rule("assign", rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, True, assigned_value),
    Rule("access", rb"AKIA[A-Z0-9]+", 20),
    # A shorter run of digits has no long one inside, so the length can stand in the pattern.
    Rule("hex", rb"[0-9a-f]{24,}", 24),
)
RULES = (
    *BASE_RULES,
    Rule("private_key", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
    Rule("bearer", rb"bearer +[A-Za-z0-9._~+/=-]+", 27, True),
    Rule("signed", rb"eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 30),
    Rule("prefixed", rb"(gh[pousr]_|sk_live_|xox[abprs]-)[A-Za-z0-9-]+", 20),
)


@lru_cache(maxsize=4)
def automata(rules: tuple[Rule, ...]) -> tuple[Automaton, list[Automaton]]:
    return compiled([(r.pattern, r.fold) for r in rules]), [compiled([(r.pattern, r.fold)], anchored=True) for r in rules]


def spans_of(text: bytes, rule: Rule, own: Automaton) -> list[tuple[int, int]]:
    """Spans of one rule in a text, by its own anchored automaton."""
    found, at, moves = [], 0, own.moves.tolist()
    classes, codes = own.classes, own.class_of[np.frombuffer(text, np.uint8)].tolist()
    first = [moves[own.start * classes + c] for c in range(classes)]
    while at < len(codes):
        state, end, place = first[codes[at]], -1, at + 1
        while state != own.dead:
            if state >= own.accepting:
                end = place
            if place == len(codes):
                break
            state = moves[state * classes + codes[place]]
            place += 1
        if end < 0:
            at += 1
            continue
        if len(rule.measured(text[at:end])) >= rule.least:
            found.append((at, end))
        at = end
    return found


def suspicious(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, scan: Automaton) -> np.ndarray:
    """Which of the stretches [start, end) hold the end of a match of any rule: one pass over the bytes.

    The stretches go forward together, one byte of each at a time, the longest first.
    """
    order = np.argsort(starts - ends, kind="stable")
    starts, lengths = starts[order], (ends - starts)[order]
    state = np.full(len(order), scan.start, np.int32)
    highest = state.copy()
    # How many stretches are longer than j.
    longer = len(order) - np.searchsorted(lengths[::-1], np.arange(int(lengths[0]) if len(order) else 0), "right")
    step = 0
    for step, going in enumerate(longer.tolist()):
        if going < FEW:
            break
        here = scan.moves[state[:going] * scan.classes + codes[starts[:going] + step]]
        state[:going] = here
        np.maximum(highest[:going], here, out=highest[:going])
    else:
        step = len(longer)
    moves = scan.moves.tolist() if step < len(longer) else []
    for i in range(int(longer[step]) if step < len(longer) else 0):
        now, top = int(state[i]), int(highest[i])
        for code in codes[starts[i] + step : starts[i] + lengths[i]].tolist():
            now = moves[now * scan.classes + code]
            if now > top:
                top = now
        highest[i] = top
    found = np.zeros(len(order), bool)
    found[order] = highest >= scan.accepting
    return found


def scan_texts(texts: pa.Array, rules: tuple[Rule, ...], automata: tuple[Automaton, list[Automaton]]) -> list[list[tuple[int, int, int]]]:
    """Of each text its spans (start, rule number, end) in code points, in order."""
    scan, own = automata
    flat, offsets = flat_bytes(texts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(flat):
        return found
    # Stretches begin with each text and behind each byte that resets the automaton.
    reset = scan.resets[flat]
    begins = np.zeros(len(flat) + 1, bool)
    begins[1:] = reset
    begins[offsets] = True
    begins[-1] = False
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(flat))
    real = ~reset[starts] | (ends - starts > 1)
    starts, ends = starts[real], ends[real]
    hits = suspicious(scan.class_of[flat], starts, ends, scan)
    if not hits.any():
        return found
    points = np.concatenate(([0], np.cumsum((flat & 0xC0) != 0x80, dtype=np.int64)))
    for start, end in zip(starts[hits].tolist(), ends[hits].tolist(), strict=True):
        text = int(np.searchsorted(offsets, start, "right")) - 1
        stretch = flat[start:end].tobytes()
        for number, rule in enumerate(rules):
            for a, b in spans_of(stretch, rule, own[number]):
                found[text].append((int(points[start + a] - points[offsets[text]]), number, int(points[start + b] - points[offsets[text]])))
    for spans in found:
        spans.sort()
    return found


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id and spans, an array of (kind, start, end) in code points, end exclusive.

    Spans of a rule do not overlap, those of different rules may; they are in the order of their start,
    then of the rules. Null and empty texts have none.
    """

    compiled_rules = automata(rules)

    @F.arrow_udf("array<struct<kind: string, start: long, end: long>>")
    def scanned(texts: pa.Array) -> pa.Array:
        lists = [spans for piece in pieces(texts) for spans in scan_texts(piece, rules, compiled_rules)]
        flat = [span for spans in lists for span in spans]
        offsets = np.concatenate(([0], np.cumsum([len(spans) for spans in lists]))).astype(np.int32)
        columns = [pa.array([rules[s[1]].kind for s in flat], pa.string()), *(pa.array([s[i] for s in flat], pa.int64()) for i in (0, 2))]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, ["kind", "start", "end"]))

    return docs.select("doc_id", scanned(text_of()).alias("spans"))


def secret_digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of the base rules, a digest of their spans and all spans as text, one row per document.

    Null and empty texts have no spans: counts of 0, the digest of the empty text, and empty ``spans``. Rows that repeat are
    rows of their own, and an empty table gives none.
    """

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda k: k == kind)).cast("long").alias(f"n_{kind}") for kind in (r.kind for r in BASE_RULES)]
    return secret_spans(docs, rules).select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))
