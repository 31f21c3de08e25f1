"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from article_warehouse.llm.common import small, stored, text_of

# Copies that the mix takes of a document at most.
MOST_COPIES = 2
# Relative error of a source's expected words at which its multiplier counts as solved.
TOLERANCE = 1e-6
NEWTON_STEPS = 60
# Selection of extra copies: the order key has this many digits in this base.
DIGITS, BASE = 3, 1024


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """``sources`` (source, source_size) with weights dealt in turn, by code point, null last.

    The rows are one per source, as in any list of weights; they are ranked in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place % len(weights) + 1).cast("double"))


def targets(weighted: DataFrame, share: float = 1.5, limit: float = MOST_COPIES) -> DataFrame:
    """Words to take from each source (source, source_size, target).

    ``share`` times all words are dealt by weight. A target stops at ``limit`` times its source's
    words; what is above goes to the other sources by their weights, until none is above.
    """
    level = weighted.withColumn("cap", limit * F.col("source_size")).withColumn("full", F.col("cap") <= 0)
    while True:
        level = stored(level)
        over = F.col("full")
        total = level.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(over, F.col("cap"))).alias("capped"),
            F.sum(F.when(~over, F.col("weight"))).alias("weights"),
        ).first()
        if not total.weights:
            break
        per_weight = (share * total.words - (total.capped or 0.0)) / total.weights
        above = ~over & (F.col("weight") * per_weight > F.col("cap"))
        newly = level.where(above).count()
        if not newly:
            break
        level = level.withColumn("full", over | above)
    dealt = F.col("weight") * F.lit(float(per_weight)) if total.weights else F.lit(0.0)
    return level.select("source", "source_size", F.when(over, F.col("cap")).otherwise(dealt).cast("double").alias("target"))


def solve_rates(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """Multiplier of each source (source, multiplier, full) for the rates of ``_rate``.

    The rates minimise the entropy relative to one copy of each document, with the words of each
    source as constraint and copies between 0 and ``MOST_COPIES``. The dual is convex with one
    multiplier per source. Each Newton step is one aggregate over ``sizes`` (source, size, documents),
    the histogram of document sizes; steps that leave the bracket of the root are halved into it.
    """
    limit = F.col("target") >= MOST_COPIES * F.col("source_size") * (1 - 1e-12)
    state = goals.select(
        "source",
        "target",
        (F.col("source_size") / F.col("sized")).alias("mean_size"),
        limit.alias("full"),
        F.lit(0.0).alias("multiplier"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
    )
    for _ in range(NEWTON_STEPS):
        state = stored(state)
        rate, x = _rate(), F.col("size") / F.col("mean_size")
        words = F.col("documents") * F.col("size")
        sums = (
            sizes.join(small(state.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of")))
            .where("size > 0 and not full")
            .groupBy("source")
            .agg(F.sum(words * rate).alias("value"), F.sum(words * x * rate * (1 - rate / MOST_COPIES)).alias("slope"))
        )
        sums = stored(sums)
        joined = state.alias("s").join(sums.alias("v"), F.col("s.source").eqNullSafe(F.col("v.source")), "left")
        gap = F.col("value") - F.col("target")
        joined = joined.select("s.*", "value", "slope", gap.alias("gap"))
        if joined.where(F.abs("gap") > TOLERANCE * F.greatest(F.col("target"), F.lit(1e-9))).isEmpty():
            break
        low = F.when(F.col("gap") < 0, F.greatest("low", "multiplier")).otherwise(F.col("low"))
        high = F.when(F.col("gap") > 0, F.least("high", "multiplier")).otherwise(F.col("high"))
        bounded = joined.withColumns({"low": low, "high": high})
        # A step of at most 4 keeps the exponentials in range.
        step = F.greatest(F.lit(-4.0), F.least(F.lit(4.0), F.col("gap") / F.greatest(F.col("slope"), F.lit(1e-300))))
        newton = F.col("multiplier") - step
        outside = (newton <= F.col("low")) | (newton >= F.col("high"))
        halved = (F.col("low") + F.col("high")) / 2
        moved = F.when(F.coalesce(outside & F.col("low").isNotNull() & F.col("high").isNotNull(), F.lit(False)), halved)
        state = bounded.withColumn("multiplier", F.when(F.col("gap").isNull(), F.col("multiplier")).otherwise(F.coalesce(moved, newton)))
        state = state.drop("value", "slope", "gap")
    return state.select("source", "mean_size", "full", "multiplier")


def _rate() -> Column:
    """Expected copies: exponentially tilted by size, ``MOST_COPIES`` at most."""
    tilt = F.exp(-F.col("multiplier") * F.col("size") / F.col("mean_size"))
    return F.when(F.col("full"), F.lit(float(MOST_COPIES))).otherwise(MOST_COPIES / (1 + tilt))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5) -> DataFrame:
    """How often each document is taken so that the sources have their shares of all words.

    Columns: doc_id, size (words), source_size, target (both of its source), taken (words, repeats
    counted), copies (0 to ``MOST_COPIES``). A document without words is taken once. A null source is
    a source of its own. Only whole documents are taken, so a source's words differ from its target
    by about one document. The same rows give the same mix. Rows with one id, or without any, get the same draw; where
    that is the last one needed, as many of them are taken as the target has room for.
    """
    source, row_id = F.col("source").cast("string").alias("source"), F.monotonically_increasing_id().alias("row_id")
    rows = stored(docs.select("doc_id", source, word_count(text_of()).alias("size"), row_id))
    sizes = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("documents")))
    words = F.sum(F.col("size") * F.col("documents")).alias("source_size")
    sources = sizes.groupBy("source").agg(words, F.greatest(F.sum(F.when(F.col("size") > 0, F.col("documents"))), F.lit(1)).alias("sized"))
    goals = stored(targets(cycled_weights(sources.drop("sized")), share))
    counted = goals.alias("g").join(sources.alias("c"), F.col("g.source").eqNullSafe(F.col("c.source"))).select("g.*", "c.sized")
    solved = stored(solve_rates(sizes, stored(counted)))
    by_source = goals.alias("g").join(solved.alias("m"), F.col("g.source").eqNullSafe(F.col("m.source")), "left")
    by_source = stored(by_source.select(F.col("g.source").alias("of"), "source_size", "target", "mean_size", "full", "multiplier"))
    rated = rows.join(small(by_source), F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "rate", F.when(F.col("size") > 0, _rate()).otherwise(F.lit(1.0))
    )
    return _rounded(rated).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies"
    )


def _rounded(rated: DataFrame) -> DataFrame:
    """Whole copies: the floor of each rate, and one more for the first documents in the order of
    draw / fraction (sequential Poisson sampling) until the source's target is met.

    Where the order ends is found digit by digit of the order key, by sums per source and digit. Rows that share the
    last key are taken in the order of ids and sizes, and among equal ones in the order of partitions.
    """
    draw = (F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    whole = F.floor(F.col("rate"))
    part = F.col("rate") - whole
    order = draw / F.greatest(part, F.lit(1e-12))
    key = F.least(F.floor(order / (1 + order) * float(BASE**DIGITS)), F.lit(BASE**DIGITS - 1))
    drawn = rated.select(
        "doc_id", "source", "size", "source_size", "target", "row_id",
        whole.cast("long").alias("whole"),
        F.when((part > 0) & (F.col("size") > 0), key.cast("long")).alias("key"),
    )
    # Words still to take, and the leading digits of the key that the last extra copy has.
    fixed = drawn.groupBy("source").agg(F.sum(F.col("size") * F.col("whole")).alias("fixed"), F.first("target").alias("target"))
    cut = stored(fixed.select(F.col("source").alias("of"), (F.col("target") - F.col("fixed")).alias("left"), F.lit(0).cast("long").alias("lead")))
    for digit in range(DIGITS):
        below = BASE ** (DIGITS - 1 - digit)
        bucket = F.floor(F.col("key") / below)
        sums = (
            drawn.where("key is not null")
            .join(small(cut), F.col("source").eqNullSafe(F.col("of")))
            .where(F.floor(bucket / BASE) == F.col("lead"))
            .groupBy("of", bucket.alias("bucket"))
            .agg(F.sum("size").alias("words"), F.first("left").alias("left"))
        )
        # At most BASE rows per source.
        before = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        run = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        reached = run.where("before < left or before = 0").groupBy("of").agg(
            F.max("bucket").alias("bucket"), F.max_by(F.col("left") - F.col("before"), "bucket").alias("left")
        )
        cut = stored(
            cut.alias("c").join(reached.alias("r"), F.col("c.of").eqNullSafe(F.col("r.of")), "left").select(
                "c.of", F.coalesce("r.left", "c.left").alias("left"), F.coalesce("r.bucket", F.lit(-1)).cast("long").alias("lead")
            )
        )
    # At the last key: how many of the equal rows of each partition the rest of the target has room for.
    ends = drawn.withColumn("part", F.shiftright("row_id", 33)).join(small(cut), F.col("source").eqNullSafe(F.col("of")))
    at_end = F.coalesce(F.col("key") == F.col("lead"), F.lit(False))
    same = ["of", "doc_id", "size", "part"]
    tied = ends.where(at_end).groupBy(*same).agg(F.count(F.lit(1)).alias("rows"), F.first("left").alias("left"))
    # A few keys at most are alike by chance, so a source has a row for each partition here.
    earlier = Window.partitionBy("of").orderBy("doc_id", "size", "part").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("left") - F.coalesce(F.sum(F.col("size") * F.col("rows")).over(earlier), F.lit(0))
    taken = F.greatest(F.lit(0), F.least(F.col("rows"), F.floor(room / F.col("size") + 0.5)))
    quotas = stored(tied.select(*[F.col(name).alias(f"q_{name}") for name in same], taken.alias("quota")))
    place = F.row_number().over(Window.partitionBy(*same).orderBy("row_id")).alias("place")
    alike = [F.col(name).eqNullSafe(F.col(f"q_{name}")) for name in same]
    last = ends.where(at_end).select("*", place).join(small(quotas), alike).withColumn("extra", (F.col("place") <= F.col("quota")).cast("long"))
    others = ends.where(~at_end).withColumn("extra", F.coalesce((F.col("key") <= F.col("lead")).cast("long"), F.lit(0)))
    columns = ["doc_id", "size", "source_size", "target", (F.col("whole") + F.col("extra")).alias("copies")]
    return others.select(*columns).unionByName(last.select(*columns))
