"""Sets of article keys as bitmaps and digests over ranges of ids.

An id stands at a place of its own: ranges of ``RANGE`` ids are a bitmap of 4 KB each, and as ids of a period lie close
together, a bitmap takes little more than a bit for each. Keys that are no whole numbers share places below all ids, by
their hash; there a bitmap can name a key that is not in it, so what it finds has to be looked at.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from article_warehouse.operators.merge import sized_keys
from article_warehouse.schemas import ARTICLE_KEY

# Ids of a range: the bits of one bitmap of the ``bitmap`` functions.
RANGE_BITS = 15
RANGE = 1 << RANGE_BITS
# Places for keys that are no whole numbers.
HASHED_PLACES = 1 << 25
# Primes below 2 ** 31, so that the square of a remainder is a 64-bit number.
DIGEST_PRIMES = (2147483647, 2147483629)


def _number(key: Column) -> Column:
    """The whole number that a key is the usual text of, else null; also for numbers near the ends of 64 bits."""
    number = key.try_cast("bigint")
    return F.when((number.cast("string") == key) & number.between(-(1 << 61), 1 << 61), number)


def key_place(key: Column) -> Column:
    hashed = -F.lit(1 << 62) + F.pmod(F.xxhash64(key), F.lit(HASHED_PLACES))
    return F.coalesce(_number(key), hashed)


def key_range(key: Column) -> Column:
    """Number of the range of ids that a key is in: 0 for ids 1 to ``RANGE``."""
    return F.shiftright(key_place(key) - 1, RANGE_BITS)


def key_bit(key: Column) -> Column:
    """Place of a key in the bitmap of its range."""
    return (key_place(key) - 1).bitwiseAND(RANGE - 1)


def digest_terms(key: Column) -> list[Column]:
    """Two numbers for a key whose sums tell sets of keys apart: cubes modulo a prime, which any database can compute."""
    number = F.coalesce(_number(key), F.xxhash64(key))
    terms = []
    for prime in DIGEST_PRIMES:
        rest = number % prime
        terms.append(rest * rest % prime * rest % prime)
    return terms


def key_digests(keys: DataFrame, key: str = ARTICLE_KEY) -> DataFrame:
    """Number of keys and sums of their digest terms per range: key_range, keys, digest_a, digest_b.

    The sums don't depend on the order, and sums of parts add up to those of the whole.
    """
    first, second = digest_terms(F.col(key))
    return keys.groupBy(key_range(F.col(key)).alias("key_range")).agg(
        F.count(F.lit(1)).alias("keys"), F.sum(first).alias("digest_a"), F.sum(second).alias("digest_b")
    )


def digest_query(table: str, column: str = "id", where: str = "deleted_at IS NULL") -> str:
    """``key_digests`` of a database table's ids as one aggregate in its SQL, of rows that are not deleted."""
    number = f"CAST({column} AS bigint)"
    sums = []
    for name, prime in zip(("digest_a", "digest_b"), DIGEST_PRIMES, strict=True):
        rest = f"mod({number}, {prime})"
        sums.append(f"CAST(sum(mod(mod({rest} * {rest}, {prime}) * {rest}, {prime})) AS bigint) AS {name}")
    return (
        f"SELECT CAST(floor(({number} - 1) / {RANGE}.0) AS bigint) AS key_range, count(*) AS keys, {', '.join(sums)} "
        f"FROM {table} WHERE {where} GROUP BY 1"
    )


def differing_ranges(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """Ranges in which ``mine`` has keys and both sides' digests differ: key_range, keys (of both sides)."""
    names = ["keys", "digest_a", "digest_b"]
    own, other = mine.where("keys > 0").alias("m"), theirs.alias("t")
    same = [F.col(f"m.{name}").eqNullSafe(F.col(f"t.{name}")) for name in names]
    found = own.join(other, "key_range", "left").where(~(same[0] & same[1] & same[2]))
    both = F.col("m.keys") + F.coalesce("t.keys", F.lit(0))
    return found.select("key_range", both.alias("keys"))


def id_spans(ranges: Iterable[int]) -> list[tuple[int, int]]:
    """Ids ``[first, end)`` of ranges, adjoining ones together."""
    spans: list[tuple[int, int]] = []
    for number in sorted(ranges):
        first = number * RANGE + 1
        if spans and spans[-1][1] == first:
            spans[-1] = (spans[-1][0], first + RANGE)
        else:
            spans.append((first, first + RANGE))
    return spans


def key_bitmaps(rows: DataFrame, *partition: str, key: str = ARTICLE_KEY) -> DataFrame:
    """Bitmaps of all keys and digests of the active ones, for each partition and range.

    Columns: the partition's, key_range, bitmap, keys, digest_a, digest_b. Rows need the key and ``is_deleted``.
    """
    first, second = digest_terms(F.col(key))
    active = F.col("is_deleted") == F.lit(False)
    return rows.groupBy(*partition, key_range(F.col(key)).alias("key_range")).agg(
        F.bitmap_construct_agg(key_bit(F.col(key))).alias("bitmap"),
        F.count_if(active).alias("keys"),
        F.coalesce(F.sum(F.when(active, first)), F.lit(0)).alias("digest_a"),
        F.coalesce(F.sum(F.when(active, second)), F.lit(0)).alias("digest_b"),
    )


def located(bitmaps: DataFrame, keys: DataFrame, count: int, *partition: str, key: str = ARTICLE_KEY) -> DataFrame:
    """Partitions whose bitmaps have each of ``count`` keys; only bitmaps of ranges between the keys' are read."""
    placed = keys.select(key, key_range(F.col(key)).alias("key_range"), key_bit(F.col(key)).alias("bit"))
    ends = placed.agg(F.min("key_range").alias("first"), F.max("key_range").alias("last")).first()
    if ends["first"] is None:
        return keys.select(key).join(bitmaps.select(*partition).limit(0))
    near = bitmaps.where(F.col("key_range").between(ends["first"], ends["last"])).select(*partition, "key_range", "bitmap")
    byte = "cast(conv(hex(substring(bitmap, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)"
    held = F.expr(f"shiftright({byte}, cast(bit % 8 as int)) & 1") == 1
    return near.join(sized_keys(placed, count), "key_range").where(held).select(key, *partition)
