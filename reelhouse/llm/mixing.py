"""Mixing sources to target token weights by entropy balancing.

Among all document rates that meet each source's token target, the rates
closest to 1 in relative entropy are exponentially tilted,
``rate = min(CAP, exp(tilt * size / mean size))``, with one tilt for each
source.  The tilts solve a convex dual; they are found by safeguarded Newton
steps, each one distributed aggregate over the (source, size) counts of the
corpus.  Rates become whole copies: the integer part always, and one more for
the documents that come first in a hashed order, up to the words their source
still lacks.

Targets: sources in code-point order (null last) weigh 1, 2, 3, 1, 2, ... and
share ``budget`` times all words; a target stops at CAP times its source's
words, and the excess is shared again by weight until no target is above.

The driver sees only scalars.  Documents meet their source's few numbers in a
plain join that adaptive execution may split, and every per-source quantity is
an aggregate with map-side combination, so a source may hold most rows.

Edge cases: null text has size 0 and is taken 0 words; null sources are one
source; a source without words has target 0; repeated rows are documents of
their own, ordered alike; an empty table gives an empty result; only the id,
source and text columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored

CAP = 3
WEIGHTS = (1, 2, 3)
WORD = r"[^\x20\x09-\x0D]+"
TOLERANCE = 1e-9          # of a source's target, for the tilts
MOST_STEPS = 60
NUDGES = 2                # corrections of a copy a source after rounding
SLICES = 4096             # of the hashed order, at each of its two levels


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size of every document."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def _weighted(totals: DataFrame) -> DataFrame:
    """Adds ``weight`` by the rank of the source, without one task seeing all sources:
    ranges of sources are counted, and each source is numbered within its range."""
    n = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").asc_nulls_last()]
    ranged, _ = stored(totals.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()),
                       "mix-sources")
    before, offsets = 0, {}
    for r in sorted(ranged.groupBy("range").count().collect()):   # one row for each partition
        offsets[r["range"]], before = before, before + r["count"]
    if not offsets:
        return ranged.withColumn("weight", F.lit(1)).drop("range")
    from pyspark.sql import Window
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    first = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])
    rank = first[F.col("range")] + inside
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    return ranged.withColumn("weight", weights[(rank % len(WEIGHTS)).cast("int")]).drop("range")


def targets(totals: DataFrame, budget: float = 1.0) -> DataFrame:
    """source, source_size, target.  ``totals`` has source, source_size, weight."""
    total = totals.agg(F.sum("source_size")).first()[0] or 0
    wanted = total * budget
    level = None                 # words per unit of weight of the sources that are not full
    while True:
        full = F.lit(False) if level is None else level * F.col("weight") > CAP * F.col("source_size")
        got = totals.agg(F.sum(F.when(full, CAP * F.col("source_size"))).alias("taken"),
                         F.sum(F.when(~full, F.col("weight"))).alias("weight"),
                         F.count(F.when(full, 1)).alias("n")).first()
        if not got["weight"]:
            return totals.withColumn("target", (CAP * F.col("source_size")).cast("double")).drop("weight")
        new = (wanted - (got["taken"] or 0)) / got["weight"]
        if level is not None and new <= level:
            break
        level = new
    share = F.least(level * F.col("weight"), CAP * F.col("source_size")).cast("double")
    return totals.withColumn("target", share).drop("weight")


def _rate(size: Column) -> Column:
    """Copies wanted of a document, from its source's tilt, mean and target."""
    tilted = F.exp(F.least(F.col("tilt") * size / F.col("mean"), F.lit(math.log(CAP))))
    return F.when(F.col("target") >= CAP * F.col("source_size"), F.lit(float(CAP))).otherwise(tilted)


def tilts(counts: DataFrame, aims: DataFrame) -> DataFrame:
    """source, source_size, target, mean, tilt.  Each step: every source's words at its
    tilt and their slope, summed over the (source, size) counts; then a Newton step, or
    the middle of the bracket where Newton leaves it."""
    spark = counts.sparkSession
    small = counts.where("size > 0").groupBy("source").agg(
        F.min("size").alias("least"), (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = aims.join(small.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    state = state.select(
        "source", "source_size", "target", F.coalesce("mean", F.lit(1.0)).alias("mean"),
        F.lit(0.0).alias("tilt"),
        (F.lit(-750.0) * F.col("mean") / F.col("least")).alias("low"),
        (F.lit(math.log(CAP)) * F.col("mean") / F.col("least")).alias("high"))
    state, path = stored(state, "mix-tilts")
    for _ in range(MOST_STEPS):
        c = counts.where("size > 0").withColumnRenamed("source", "s").join(
            state, F.col("source").eqNullSafe(F.col("s")))
        x, rate = F.col("size"), _rate(F.col("size"))
        words = x * F.col("n") * rate
        sums = c.groupBy("s").agg(
            F.sum(words).alias("words"),
            F.sum(F.when(F.col("tilt") * x / F.col("mean") < math.log(CAP), words * x / F.col("mean"))
                  .otherwise(0.0)).alias("slope"))
        j = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        over = F.col("words") > F.col("target")
        j = j.withColumn("low", F.when(over, F.col("low")).otherwise(F.col("tilt"))) \
             .withColumn("high", F.when(over, F.col("tilt")).otherwise(F.col("high")))
        # Newton on log(words): from either side it overshoots little however steep the tilt
        step = F.col("tilt") + F.log(F.col("target") / F.col("words")) * F.col("words") / F.col("slope")
        inside = (F.col("slope") > 0) & (step > F.col("low")) & (step < F.col("high"))
        off = F.abs(F.col("words") - F.col("target")) / F.greatest(F.col("target"), F.lit(1.0))
        settled = F.coalesce((off <= TOLERANCE) | (F.col("target") >= CAP * F.col("source_size")), F.lit(True))
        j = j.withColumn("settled", settled).withColumn(
            "tilt", F.when(settled, F.col("tilt")).when(inside, step)
            .otherwise((F.col("low") + F.col("high")) / 2))
        new, new_path = stored(j.select("source", "source_size", "target", "mean", "tilt", "low", "high", "settled"),
                               "mix-tilts")
        drop_stored(spark, path)
        state, path = new, new_path
        if not state.where("not settled").limit(1).count():
            break
    return state.select("source", "source_size", "target", "mean", "tilt")


def _slice(place: Column, level: int) -> Column:
    """Number of the slice ``place`` (0 to 1) falls in; level 2 divides a slice of level 1."""
    first = F.floor(place * SLICES)
    return first if level == 1 else F.floor((place * SLICES - first) * SLICES)


def copies(sized: DataFrame, state: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken.  The extra copies go down a
    hashed order, in which a document comes earlier the larger its fraction, to the
    slice where the source's words reach its target."""
    d = sized.withColumnRenamed("source", "s").join(state, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rate = _rate(F.col("size"))
    whole = F.floor(rate + 1e-9)
    frac = F.greatest(rate - whole, F.lit(0.0))
    # 0..1, uniform by hash; divided by the fraction and folded back into 0..1
    u = (F.pmod(F.xxhash64("doc_id", "size", F.lit("mix")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    key = u / frac
    place = F.when(frac > 0, key / (1 + key))
    d = d.select("doc_id", "source", "size", "source_size", "target", whole.alias("whole"), place.alias("place"))
    d = d.withColumn("s1", _slice(F.col("place"), 1)).withColumn("s2", _slice(F.col("place"), 2))
    d = d.withColumn("row", F.monotonically_increasing_id())
    d, _ = stored(d, "mix-copies")

    from pyspark.sql import Window
    by_source = Window.partitionBy("source").orderBy("s1")
    lack = d.groupBy("source", "target").agg(F.sum(F.col("size") * F.col("whole")).alias("base"))
    lack = lack.select("source", (F.col("target") - F.col("base")).alias("lack"))
    # at most SLICES rows of a source are in one window
    one = d.where("place is not null").groupBy("source", "s1").agg(F.sum("size").alias("w"))
    one = one.withColumn("before", F.sum("w").over(by_source) - F.col("w"))
    one = _same(one, lack)
    cut1 = one.where((F.col("before") <= F.col("lack")) & (F.col("before") + F.col("w") > F.col("lack"))).select(
        "source", F.col("s1").alias("cut1"), (F.col("lack") - F.col("before")).alias("lack"))
    cut1, _ = stored(cut1, "mix-cuts")         # one row a source, of known size before it meets documents
    two = _same(d.where("place is not null"), cut1).where(F.col("s1") == F.col("cut1"))
    two = two.groupBy("source", "s2", "lack").agg(F.sum("size").alias("w"))
    two = two.withColumn("upto", F.sum("w").over(Window.partitionBy("source").orderBy("s2")))
    # the slice that crosses the target is taken when that ends nearer to it
    cut2 = two.where(F.col("upto") - F.col("w") / 2 <= F.col("lack")).groupBy("source").agg(F.max("s2").alias("cut2"))
    cuts = _same(lack, cut1.select("source", "cut1"), "left")
    cuts = _same(cuts, cut2, "left").select("source", "lack", "cut1", F.coalesce("cut2", F.lit(-1)).alias("cut2"))
    # no crossing slice: all or none of the source's fractions are taken
    cuts, _ = stored(cuts, "mix-cuts")
    d = _same(d, cuts)
    extra = F.when(F.col("place").isNull(), 0).when(F.col("cut1").isNull(), (F.col("lack") > 0).cast("int")).otherwise(
        ((F.col("s1") < F.col("cut1")) | ((F.col("s1") == F.col("cut1")) & (F.col("s2") <= F.col("cut2")))).cast("int"))
    d = d.select("row", "doc_id", "source", "size", "source_size", "target",
                 (F.col("whole") + extra).cast("int").alias("copies"))
    for _ in range(NUDGES):
        d = _nudged(d)
    return d.select("doc_id", "source", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies")


def _nudged(d: DataFrame) -> DataFrame:
    """One copy more or less of one document a source, where that brings its words nearer
    to its target: what is left matters only to sources of few documents."""
    d, _ = stored(d, "mix-copies")
    off = d.groupBy("source").agg((F.max("target") - F.sum(F.col("size") * F.col("copies"))).alias("off"))
    off, _ = stored(off, "mix-cuts")
    moves = _same(d.where("size > 0"), off)
    step = F.when((F.col("off") > 0) & (F.col("copies") < CAP), 1).when((F.col("off") < 0) & (F.col("copies") > 0), -1)
    gain = F.abs(F.col("off")) - F.abs(F.col("off") - step * F.col("size"))
    # ties by the document, not by where it stands: any partitions give the same mix
    order = F.struct("gain", F.xxhash64("doc_id", "size").alias("by"), "doc_id", "copies", "row", "step")
    best = moves.withColumn("step", step).withColumn("gain", gain).where("gain > 0").groupBy("source").agg(
        F.max(order).alias("best"))
    chosen = best.select(F.col("best.row").alias("of"), F.col("best.step").alias("step"))
    return d.join(chosen, F.col("row") == F.col("of"), "left").withColumn(
        "copies", F.col("copies") + F.coalesce("step", F.lit(0))).drop("of", "step")


def _same(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on source, nulls alike."""
    right = right.withColumnRenamed("source", "of")
    return left.join(right, F.col("source").eqNullSafe(F.col("of")), how).drop("of")


def mix(docs: DataFrame, budget: float = 1.0) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies of every document."""
    sized, _ = stored(sizes(docs), "mix-sizes")
    counts, _ = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    totals = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aims, _ = stored(targets(_weighted(totals), budget), "mix-targets")
    return copies(sized, tilts(counts, aims))


def taken(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")
