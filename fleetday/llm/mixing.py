"""Mixing sources to target weights by a time-varying curriculum. DataFrame functions only.

Every source has a target number of words and a schedule of weights over training time 0..1, straight
between its knots. The integral of the schedule, scaled to the target, is the source's cumulative
demand. The source's documents lie one after the other in a fixed order, and a copy's place in that
sequence is turned into a training time by inverting the demand. Sorting by time gives the mix.

Defined cases: a null text has no words; documents without words are never taken; null is a source of
its own (the last one); rows that are equal in id and text share a place in the order and are all kept;
a null id is ordered by its text. Columns that the caller's table has besides are passed through; those
named like a result or helper are replaced by it. An empty table gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetday.llm.common import WORD, literal_rows

#: Relative weight at the start and at the end of training, by base weight: heavy sources come late.
RAMPS = {5.0: (0.5, 1.5), 2.0: (1.0, 1.0), 1.0: (1.5, 0.5)}
CYCLE = (5.0, 2.0, 1.0)
RESULTS = ("size", "source_size", "target", "copies", "copy", "position", "_before", "_pieces", "_key", "_range", "_inside", "_offset", "_s", "_r")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column, text: Column) -> Column:
    """32 hexadecimal digits that fix a document's place within its source."""
    return F.md5(F.concat_ws("|", doc_id.cast("string"), text))


def source_sizes(sized: DataFrame) -> DataFrame:
    return sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))


def cycled_weights(sizes: DataFrame, cycle: tuple[float, ...] = CYCLE) -> DataFrame:
    """`weight` by the source's rank in code points, null last. One row per source goes through the window."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return sizes.withColumn("weight", F.element_at(weights, (rank % len(cycle) + 1).cast("int")))


def targets(weighted: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """`target`: `share` of all words by weight, no source above `most` times its size.

    Filling up by weight leaves a common level per unit of weight for the sources that aren't full;
    sources fill in the order of size / weight, so sums over that order give the level at once.
    """
    by_fill = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_first())
    everything = Window.partitionBy()
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    capped = weighted.withColumn("_cap", F.lit(most) * F.col("source_size"))
    level = (
        F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = capped.withColumn("_level", level).withColumn("_full", F.col("_cap") <= F.col("weight") * F.col("_level"))
    # the first source that isn't full has the common level; all behind it share it
    common = F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("weight"), F.col("source").isNotNull(), "source", "_level"))).over(everything)
    return filled.withColumn(
        "target",
        F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("weight") * common["_level"]).cast("double"),
    ).drop("_cap", "_level", "_full")


def ramp_schedules(weighted: DataFrame) -> DataFrame:
    """`knots`: (t, w) at the start and the end of training, by base weight."""
    ramp = literal_rows(
        weighted.sparkSession,
        [{"weight": w, "knots": [{"t": 0.0, "w": a}, {"t": 1.0, "w": b}]} for w, (a, b) in RAMPS.items()],
        "weight double, knots array<struct<t: double, w: double>>",
    )
    return weighted.join(ramp, "weight", "left")


def segments(knots: Column) -> Column:
    """The schedule's pieces between knots with the share of the integral before and in each."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(knots) - 1),
        lambda i: F.struct(
            F.element_at(knots, i)["t"].alias("t0"),
            (F.element_at(knots, i + 1)["t"] - F.element_at(knots, i)["t"]).alias("dt"),
            F.element_at(knots, i)["w"].alias("w0"),
            (F.element_at(knots, i + 1)["w"] - F.element_at(knots, i)["w"]).alias("dw"),
        ),
    )
    area = lambda s: s["dt"] * (s["w0"] + s["dw"] / 2)
    total = F.aggregate(pairs, F.lit(0.0), lambda x, s: x + area(s))
    return F.transform(
        pairs,
        lambda s, i: F.struct(
            s["t0"].alias("t0"), s["dt"].alias("dt"), (s["w0"] / total).alias("w0"), (s["dw"] / total).alias("dw"),
            (F.aggregate(F.slice(pairs, F.lit(1), i), F.lit(0.0), lambda x, p: x + area(p)) / total).alias("before"),
            (area(s) / total).alias("area"),
        ),
    )


def training_time(share: Column, pieces: Column) -> Column:
    """The time at which the cumulative demand reaches `share` (0..1) of the target."""
    inside = F.filter(pieces, lambda s: (s["before"] <= share) & (s["area"] > 0))
    s = F.element_at(inside, -1)
    x = F.least(share - s["before"], s["area"])
    # dt * (w0 u + dw u^2 / 2) = x, in the form that also holds for dw = 0
    need = x / s["dt"]
    u = 2 * need / (s["w0"] + F.sqrt(F.greatest(s["w0"] * s["w0"] + 2 * s["dw"] * need, F.lit(0.0))))
    return F.when(share <= 0, F.lit(0.0)).otherwise(s["t0"] + s["dt"] * F.least(u, F.lit(1.0)))


def placed(sized: DataFrame, plan: DataFrame, rows: int) -> DataFrame:
    """`sized` with its source's plan, `_before` (words of its source ahead of it) and `copies`.

    `sized` has source, size and _key; `plan` has one row per source. A source is cut into ranges of
    the order key, as many as the square root of all rows: sums per range, running sums over a
    source's ranges, then running sums inside a range. So a source with a third of all rows is still
    shared by many tasks, and neither kind of window holds more than about that square root of rows
    of a source.
    """
    ranges = 1 << max(0, math.ceil(math.log2(max(1, rows)) / 2))
    at = F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)).cast("long")
    cut = sized.withColumn("_range", at)
    by_range = cut.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_range.select(
        "source", "_range", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset")
    ).join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    offsets = offsets.withColumnsRenamed({"source": "_s", "_range": "_r"})
    inside = Window.partitionBy("source", "_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    docs = cut.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = docs.join(offsets, (F.col("_range") == F.col("_r")) & F.col("source").eqNullSafe(F.col("_s")))
    before = F.col("_offset") + F.col("_inside")
    # a copy is taken if its middle lies ahead of the target: the sum misses it by half a document at most
    reach = (F.col("target") - before - F.col("size") / 2) / F.col("source_size")
    copies = F.when((F.col("size") > 0) & (reach > 0), F.ceil(reach)).otherwise(F.lit(0)).cast("long")
    return joined.withColumn("_before", before).withColumn("copies", copies).drop("_s", "_r", "_range", "_inside", "_offset")


def curriculum(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               cycle: tuple[float, ...] = CYCLE, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """All columns of `docs` (source as `source`) with size, source_size, target, copies and _before."""
    kept = docs.drop(*[c for c in RESULTS if c not in (doc_id, text, source)])
    sized = kept.withColumn("source", F.col(source)).withColumns(
        {"size": word_count(F.col(text)), "_key": order_key(F.col(doc_id), F.col(text))}
    )
    sizes = source_sizes(sized)
    rows = sizes.agg(F.sum("_rows")).first()[0] or 0
    plan = ramp_schedules(targets(cycled_weights(sizes, cycle), share, most)).select(
        "source", "source_size", "target", segments(F.col("knots")).alias("_pieces")
    )
    return placed(sized, plan, rows)


def positions(mixed: DataFrame) -> DataFrame:
    """One row per taken copy: `copy` (0, 1, ...) and `position`, its training time (0..1)."""
    copies = mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    start = F.col("copy") * F.col("source_size") + F.col("_before")
    return copies.withColumn("position", training_time(start / F.col("target"), F.col("_pieces")))


def in_training_order(taken: DataFrame) -> DataFrame:
    """Range partitions by position, sorted inside: the files in their order are the mix."""
    return taken.repartitionByRange("position", "_key", "copy").sortWithinPartitions("position", "_key", "copy")
