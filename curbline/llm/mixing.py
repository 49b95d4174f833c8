"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, as close to one as the targets allow in relative entropy: minimise the sum of
r log r - r over documents, under the constraint that each source's rates times sizes sum to its
target and that no rate is above ``most``. The convex dual has one multiplier per source; its minimum tilts
rates exponentially, r = min(most, exp(multiplier * size / mean size)). Newton iterations find the multipliers,
each one aggregation over the distributed counts of (source, size); halving a bracket takes over where a Newton
step would leave it.

Rates become whole copies by systematic rounding along the order of sizes within a source: the copies of
every prefix differ from the sum of its rates by less than one, so a source misses its target by less than its
largest document. Of some starting points of the rounding each source takes the one that misses least. The order is cut into salted groups, numbered apart, with prefix sums between.

Defined results: null text has size 0; documents of size 0 are taken neither once nor more often; a
source is a value of ``source``, null being the last one; repeated rows each count; ties in size are ordered
by hashed id, and a table without rows gives no rows. Other columns are not read, and ``mixed`` hands them on: of rows
equal in id and text, those of the row whose other columns are least as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import remove_folder
from .runtime import stored, stored_at, whole_row

#: Weights of the sources in the order of their names, repeated as often as needed.
WEIGHTS = (1.0, 2.0, 3.0)
#: Times that a document, and so a source, is taken at most.
MOST = 3
#: Rows of equal source and size that one task numbers, about.
GROUP_ROWS = 2_000
#: Newton rounds at most; five to ten are usual. A bracket halves where a step leaves it.
ROUNDS = 80
#: Starting points tried for the rounding.
STARTS = 48
_CLOSE = 1e-7
_FIXED = "decimal(38,9)"


def words(text: Column) -> Column:
    """Number of words; ASCII white space separates them. Null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def with_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``sources`` (source, own) with the words each is to give, ``target``.

    All words are shared by weight; a source stops at ``most`` times its own, and the rest is shared on. So
    the target is min(most * own, unit * weight) for the one unit at which targets sum to all words: with sources in
    the order in which a growing unit caps them, it follows from sums before and after. One row per source.
    """
    named = sources.withColumn("_at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = named.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int")))
    by_cap = Window.orderBy(most * F.col("own") / F.col("weight"), "_at")
    earlier, later = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    unit = (F.sum("own").over(everything) - F.coalesce(F.sum(most * F.col("own")).over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    # The first source that its unit does not cap stays free, and all after it.
    free = F.when(unit * F.col("weight") < most * F.col("own"), unit)
    return (weighed.withColumn("_free", free).withColumn("_unit", F.first("_free", ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select("source", "own", "docs", F.least(
            most * F.col("own").cast("double"), F.coalesce(F.col("_unit") * F.col("weight"), F.lit(float("inf")))).alias("target")))


def balance(counts: DataFrame, sources: DataFrame, most: float = MOST) -> DataFrame:
    """(source, size, n, target, own, rate): the rate of each document, by Newton's method on the dual.

    ``counts`` has source, size, n; ``sources`` has source, own, docs, target. Each round sums the counts by source
    and writes the new multipliers, a row per source, to the shared folder.
    """
    size, multiplier = F.col("size").cast("double"), F.col("multiplier")
    x = size / F.col("mean")
    tilted = F.exp(F.least(multiplier * x, F.lit(300.0)))
    rate = F.when(F.col("full"), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), tilted))
    state = sources.select(
        "source", "own", "target", (F.col("own") / F.col("docs")).alias("mean"),
        (F.col("target") >= most * F.col("own") * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("multiplier"), F.lit(-300.0).alias("low"), F.lit(300.0).alias("high"), F.lit(False).alias("done")).where("own > 0")
    state, folder = stored_at(state, "multipliers")
    columns = state.columns
    counts = counts.where("size > 0")

    def joined(state: DataFrame) -> DataFrame:
        return counts.join(state.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    for _ in range(ROUNDS):
        # Sums of doubles depend on the order in which they arrive; these are the same on each run.
        sums = joined(state).groupBy(*columns).agg(
            F.sum((F.col("n") * size * rate).cast(_FIXED)).cast("double").alias("got"),
            F.sum(F.when(tilted < most, F.col("n") * size * x * tilted).otherwise(0.0).cast(_FIXED)).cast("double").alias("slope"))
        over = F.col("got") - F.col("target")
        low = F.when(over < 0, multiplier).otherwise(F.col("low"))
        high = F.when(over < 0, F.col("high")).otherwise(multiplier)
        step = multiplier - over / F.col("slope")
        close = F.col("full") | (F.abs(over) <= _CLOSE * F.col("own")) | (high - low < 1e-12)
        after = sums.select(
            "source", "own", "target", "mean", "full",
            F.when(close, multiplier).when((F.col("slope") > 0) & (step > low) & (step < high), step)
            .otherwise((low + high) / 2).alias("multiplier"),
            low.alias("low"), high.alias("high"), close.alias("done"))
        last = folder
        state, folder = stored_at(after.select(*columns), "multipliers")
        remove_folder(counts.sparkSession, last)  # the round before; nothing reads it any more
        if state.where(~F.col("done")).isEmpty():
            break
    else:
        raise RuntimeError(f"multipliers did not settle in {ROUNDS} rounds")
    return joined(state).select("source", "size", "n", "target", "own", rate.alias("rate"))


def starting(rates: DataFrame, sources: DataFrame) -> DataFrame:
    """``rates`` with ``start``, the point at which its source begins the rounding, chosen on the counts alone."""
    part = F.col("rate") - F.floor("rate")
    tried = rates.withColumn("start", F.explode(F.array(*[F.lit((i + 0.5) / STARTS) for i in range(STARTS)])))
    at = F.col("start") + F.col("offset")
    taken = F.col("size") * (F.col("n") * F.floor("rate") + F.floor(at + F.col("n") * part) - F.floor(at))
    sums = tried.groupBy("source", "start").agg(F.sum(taken).alias("taken")).alias("t")
    miss = F.abs(F.col("taken") - F.col("target"))
    best = (sums.join(sources.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source"))).groupBy("t.source")
            .agg(F.min(F.struct(miss.alias("miss"), F.col("start"))).alias("best"))
            .select(F.col("source").alias("_source"), F.col("best.start").alias("start")))
    return rates.join(best, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "n")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target, rate, copies for every row of ``docs``."""
    rows = stored(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("source").cast("string"),
                              words(F.col("text")).alias("size")).withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    salts = max(1, -(-rows.count() // GROUP_ROWS))
    # Rows equal in id and text are one row with a number of copies from here on, until each gets its share.
    equal = ["source", "size", "doc_id", "text_hash"]
    folded = stored(rows.groupBy(*equal).agg(F.count("*").alias("m")).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("salt")), F.lit(salts))), "mix-folded")
    group = ["source", "size", "salt"]
    salted = stored(folded.groupBy(*group).agg(F.sum("m").alias("n")), "mix-counts")
    counts = salted.groupBy("source", "size").agg(F.sum("n").alias("n"))
    own = counts.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("own"), F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("docs"))
    sources = stored(with_targets(own, weights, most), "mix-targets")
    rates = balance(counts, sources, most)
    # Sum of the fractions of all smaller sizes of the source, then of the salts before within a size.
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    part = F.col("rate") - F.floor("rate")
    rates = rates.select("source", "size", "rate", F.coalesce(F.sum(F.col("n") * part).over(smaller), F.lit(0.0)).alias("offset"))
    rates = stored(starting(rates.join(counts.alias("c"), F.col("c.source").eqNullSafe(rates["source"]) & (F.col("c.size") == rates["size"]))
                            .select(rates["*"], "n"), sources), "mix-rates")
    earlier = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = salted.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("source", "size")]
    bases = (bases.alias("b").join(rates.alias("r"), same[0] & same[1], "left")
             .join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
             .select("b.*", "rate", "offset", "start", F.col("own").alias("source_size"), "target"))
    place = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id", "text_hash"), "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    folded = folded.withColumn("first", F.coalesce(F.sum("m").over(place), F.lit(0)))
    match = [F.col(f"f.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group]
    folded = (folded.alias("f").join(bases.alias("b"), match[0] & match[1] & match[2])
              .select(*[F.col(f"f.{c}").alias(f"_{c}") for c in equal], (F.col("base") + F.col("first")).alias("first"),
                      "rate", "offset", "start", "source_size", "target"))
    # Equal rows are numbered in pieces of the input, with sums before: which one gets which number makes no difference.
    pieces = rows.withColumn("piece", F.shiftright("row", 11))
    before = Window.partitionBy(*equal).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    counted = pieces.groupBy(*equal, "piece").agg(F.count("*").alias("k"))
    repeated = counted.withColumn("earlier", F.coalesce(F.sum("k").over(before), F.lit(0))).where("k > 1 or earlier > 0").drop("k")
    inside = Window.partitionBy(*equal, "piece").orderBy("row")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"q.{c}")) for c in (*equal, "piece")]
    numbered = (pieces.withColumn("inside", F.row_number().over(inside) - 1).alias("p")
                .join(repeated.alias("q"), same[0] & same[1] & same[2] & same[3] & same[4], "left")
                .select(*[f"p.{c}" for c in equal], (F.coalesce("earlier", F.lit(0)) + F.col("inside")).alias("nth")))
    at = F.col("first") + F.col("nth")
    # The end of a row is computed as the next one's start is, so that the steps add up.
    start = F.floor(F.col("start") + F.col("offset") + at * part)
    end = F.floor(F.col("start") + F.col("offset") + (at + 1) * part)
    copies = F.coalesce(F.least(F.floor("rate") + end - start, F.lit(most)), F.lit(0)).cast("int")
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in equal]
    return (numbered.join(folded, match[0] & match[1] & match[2] & match[3])
            .select("doc_id", "text_hash", "source", "size", "source_size", "target", F.coalesce("rate", F.lit(0.0)).alias("rate"),
                    copies.alias("copies")))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, columns unchanged."""
    taken = (mix(docs, weights, most).groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
             .agg(F.sum("copies").cast("int").alias("times")).where("times > 0"))
    others = [F.col("row")[c] for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.to_json(F.struct(*others), {"ignoreNullFields": "false"}) if others else F.lit("")
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("own"), F.xxhash64("text").alias("tie"))
    # Rows equal in id and text stand for each other: the least by its other columns carries the copies of all.
    rows = rows.groupBy("own", "tie").agg(F.min_by("row", rest).alias("row"))
    joined = rows.join(taken, F.col("own").eqNullSafe(F.col("id")) & F.col("tie").eqNullSafe(F.col("hash")))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
