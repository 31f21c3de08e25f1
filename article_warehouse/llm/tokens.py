"""Token counts by a two-tier lookup on the map side."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from article_warehouse.llm.common import kept_in_worker, pieces, text_of

# Rows that the table of frequent chunks is made from, entries that it holds at most, and their length. The table only
# decides which tier answers, never the answer.
TABLE_ROWS, TABLE_ENTRIES, TABLE_CHUNK_CHARS = 2000, 32_768, 48
# Entries of a worker's cache of the rest, after which it starts anew, and the longest chunk in it.
CACHE_ENTRIES, CACHE_CHUNK_CHARS = 400_000, 256
# Bytes of text whose missed chunks are encoded together.
TEXT_BYTES = 4 << 20

# Blanks that Python splits at beside the six of ASCII; with one of them a text is split by pattern.
_OTHER_BLANK = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_MARKS = ".,;:!?"
_BLANK = re.compile("[ \t\n\v\f\r]+")


def chunks(text: str) -> list[str]:
    """Text between ASCII blanks. No token crosses a blank, so counts of chunks add up.

    A text of ASCII only is lowered first, as the tokenizer does itself, so that fewer chunks differ; not so where it
    might have a special token, which has to be found before.
    """
    if text.isascii() and "<|" not in text:
        text = text.lower()
    if _OTHER_BLANK.search(text):
        return [chunk for chunk in _BLANK.split(text) if chunk]
    return text.split()


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    def made() -> Tokenizer:
        found = Tokenizer.from_file(path)
        found.no_truncation()
        found.no_padding()
        return found

    return kept_in_worker(f"tokenizer {path}", made)


class Lengths(dict):
    """Token counts of chunks: a broadcast table first, then what this worker encoded before."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.path, self.frequent = path, frequent

    def encode(self, found: Iterable[str]) -> None:
        tokenizer = _tokenizer(self.path)
        self.update((chunk, len(tokenizer.encode(chunk, add_special_tokens=False))) for chunk in found)

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        found = [chunks(text) for text in texts]
        if len(self) - len(self.frequent) > CACHE_ENTRIES:
            self.clear()
            self.update(self.frequent)
        missed = set().union(*found).difference(self)
        # Marks behind a word are tokens of their own, so only the word is encoded. The word is lowered before it is cut,
        # which may leave a mark of its own at its end.
        words = {chunk: word for chunk in missed if (word := chunk.rstrip(_MARKS)) != chunk and word.isalpha() and word.lower().isalpha()}
        self.encode(set(words.values()).union(missed.difference(words)).difference(self))
        self.encode({chunk[len(word) :] for chunk, word in words.items()}.difference(self))
        self.update((chunk, self[word] + self[chunk[len(word) :]]) for chunk, word in words.items())
        sums = [sum(map(self.__getitem__, listed)) for listed in found]
        # Long chunks hardly come again, and marked words are put together again.
        for chunk in missed:
            if chunk in words or len(chunk) > CACHE_CHUNK_CHARS:
                del self[chunk]
        return sums


def frequent_chunks(docs: DataFrame, path: str) -> dict[str, int]:
    """Token counts of the most frequent chunks in about ``TABLE_ROWS`` documents, sampled whatever their ids are."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(chunk for chunk in chunks(text) if len(chunk) <= TABLE_CHUNK_CHARS)
        frequent = [chunk for chunk, _ in counts.most_common(TABLE_ENTRIES)]
        table = Lengths(path, {})
        table.encode(frequent)
        yield pa.RecordBatch.from_arrays([pa.array(list(table), pa.string()), pa.array(list(table.values()), pa.int64())], ["chunk", "n"])

    share = min(1.0, TABLE_ROWS / max(1, docs.count()))
    sample = docs.select(text_of().alias("text")).sample(share, seed=3).repartition(1)
    return {row.chunk: row.n for row in sample.mapInArrow(lengths, "chunk string, n long").collect()}


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """Tokens of each whole text as the ``tokenizers`` library gives them for the file at ``path``.

    Columns: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit``). No begin, end or added
    special tokens, no truncation; special strings in a text are special tokens, as the library's default
    has it. Null and empty texts have no bytes and no tokens. The file must be at ``path`` on each executor;
    it must not join text across blanks, which holds where the pre-tokenizer drops them.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_chunks(docs, path))

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths = Lengths(path, table.value)
        for texts in batches:
            yield pa.array([n for piece in pieces(texts, TEXT_BYTES) for n in lengths.counts(piece.to_pylist())], pa.int64())

    n_tokens = counted(text_of())
    rows = docs.select("doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"), n_tokens.alias("n_tokens"))
    return rows.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
