"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a schedule, a piecewise linear multiplier of its
weight over training time 0..1.  Targets come from the weights alone by water
filling; the schedule says when a source's words are due.  Its integral over
time is the source's cumulative demand; the time at which that demand reaches a
document's place in its source's word stream is the document's position.

All is DataFrame code.  Prefix sums over a source run in two levels, over the
buckets of a hash prefix and inside each bucket, so a source with a third of
all rows is no single task's work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evigrade.session import cut

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: For each weight in turn: (time, multiplier) knots.  Heavy sources first ebb, light ones rise.
SCHEDULES = (
    ((0.0, 1.4), (0.6, 1.0), (1.0, 0.4)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 0.8), (1.0, 1.9)),
)
DEMAND_PERCENT = 150
MOST_REPEATS = 2
#: Hex digits of the order hash that name a bucket.
BUCKET_DIGITS = 3

_SPACE = r"[\x20\x09-\x0D]+"


def count_words(text: Column) -> Column:
    """How many `[^\\x20\\x09-\\x0D]+` a text has; null: none."""
    parts = F.split(text, _SPACE)
    edges = (F.element_at(parts, 1) == "").cast("int") + (F.element_at(parts, -1) == "").cast("int")
    return F.coalesce(F.greatest(F.size(parts) - edges, F.lit(0)), F.lit(0)).cast("long")


def _segments(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(start, length, weight at the start, slope, demand before) of each piece, demand 1 in all."""
    area = sum((b - a) * (u + v) / 2 for (a, u), (b, v) in zip(knots, knots[1:]))
    out, before = [], 0.0
    for (a, u), (b, v) in zip(knots, knots[1:]):
        out.append((a, b - a, u / area, (v - u) / area / (b - a), before))
        before += (b - a) * (u + v) / 2 / area
    return out


def schedule_time(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which a source has used `share` (0..1) of its words: its integrated schedule, inverted."""
    result = None
    for start, _, weight, slope, before in _segments(knots):
        rest = F.greatest(share - before, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(weight * weight) + 2 * slope * rest, F.lit(0.0)))
        here = F.lit(start) + F.coalesce(F.try_divide(2 * rest, F.lit(weight) + root), F.lit(0.0))
        result = here if result is None else F.when(share >= before, here).otherwise(result)
    return F.least(result, F.lit(1.0))


def source_targets(
    totals: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    demand_percent: int = DEMAND_PERCENT,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """(source, source_size) -> also weight_class, weight and target, by water filling.

    Sources in code point order, null last, take the weights in turn and share
    `demand_percent` of all sizes; a target stops at `most_repeats` times its
    source's size and the excess is shared again.  The table has a row for each
    source, so its windows are small.
    """
    in_order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("weight_class") + 1).cast("double")
    known = totals.withColumn("weight_class", place.cast("int")).withColumn("weight", weight)
    everything = Window.partitionBy(F.lit(0))
    ripe = everything.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ripe.rowsBetween(Window.unboundedPreceding, -1)
    onward = ripe.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    known = known.withColumn("most", (F.col("source_size") * most_repeats).cast("double"))
    demand = F.sum("source_size").over(everything).cast("double") * demand_percent / 100
    level = (demand - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    known = known.withColumn("level", level)
    full = F.col("most") / F.col("weight") <= F.col("level")
    free_level = F.max(F.when(~full, F.col("level"))).over(everything)
    target = F.when(full, F.col("most")).otherwise(free_level * F.col("weight"))
    return known.withColumn("target", target).select("source", "source_size", "weight_class", "weight", "target")


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    demand_percent: int = DEMAND_PERCENT,
    most_repeats: int = MOST_REPEATS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """What the mix takes of every document, and when.

    docs: doc_id, text, source and any other columns, which are ignored but for
    those to keep.  One row per row: doc_id, source, size, source_size, target,
    taken (words, repeats counted), takes: array of (copy, words, time).  A source's stream is its
    documents in the order of md5(doc_id), again and again; the mix takes its
    first round(target) words, so only one document of a source is taken in part.
    Null and empty texts have size 0 and are never due.  A null source is a source
    of its own, the last.  Rows that repeat a doc_id are taken like any others.
    An empty table gives an empty result.
    """
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), order.alias("place"), *keep)
    sized = sized.withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sized = sized.withColumn("stream", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
    buckets = cut(sized.groupBy("stream", "bucket").agg(F.first("source").alias("source"), F.sum("size").alias("words")))
    totals = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(totals, weights, demand_percent, most_repeats)
    targets = targets.withColumn("stream", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))).drop("source")

    earlier = Window.partitionBy("stream").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("stream", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    offsets = offsets.join(targets, "stream")
    inside = (
        Window.partitionBy("stream", "bucket").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    at = F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = sized.withColumn("within", at).join(offsets, ["stream", "bucket"])

    wanted = F.floor(F.col("target") + 0.5).cast("long")
    copies = []
    for copy in range(most_repeats):
        begins = F.col("start") + copy * F.col("source_size")
        words = F.least(F.greatest(F.col("wanted") - begins, F.lit(0)), F.col("size"))
        share = F.coalesce(F.try_divide(begins, F.col("wanted")), F.lit(0.0))
        time = F.lit(None).cast("double")
        for kind, knots in enumerate(schedules):
            time = F.when(F.col("weight_class") % len(schedules) == kind, schedule_time(share, knots)).otherwise(time)
        copies.append(F.struct(F.lit(copy).alias("copy"), words.alias("words"), F.when(words > 0, time).alias("time")))
    placed = placed.withColumn("start", F.col("offset") + F.col("within")).withColumn("wanted", wanted)
    placed = placed.withColumn("takes", F.filter(F.array(*copies), lambda take: take["words"] > 0))
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda total, take: total + take["words"])
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "takes", *keep)


def mix_documents(docs: DataFrame) -> DataFrame:
    """docs as the mix takes them, range-sorted by the time at which each take is due.

    Same columns as docs.  A document that is taken twice has two rows; one that is
    taken in part has its first words only, with the white space between them,
    and n_chars, if there, is that of the text.  Every row is taken by itself, also
    one that repeats a doc_id.  Null texts, empty ones and those of white space have no
    words and are never taken.  A null source is a source of its own.  An empty
    table gives an empty result.
    """
    whole = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("_doc")
    plan = mix_plan(docs.select("doc_id", "text", "source", whole), keep=["_doc"])
    takes = plan.select("doc_id", "source", "size", F.explode("takes").alias("take"), "_doc")
    takes = takes.orderBy("take.time", "source", "take.copy", "doc_id")
    words, text = F.col("take.words"), F.col("_doc.text")
    part = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), 1, words.cast("int")), "")
    shown = F.when(words >= F.col("size"), text).otherwise(part)
    takes = takes.withColumn("shown", shown)
    changed = {"text": F.col("shown"), "n_chars": F.length("shown").cast("long")}
    return takes.select(*[changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])


def training_order(plan: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, source, copy, words, time, position), range-sorted by the time at which each take is due.

    Positions are gapless from 0.  The sort is by ranges of all takes; a table with a
    row for each range tells how many takes stand before it.
    """
    takes = plan.select("doc_id", "source", F.explode("takes").alias("take"), *keep)
    takes = takes.select("doc_id", "source", "take.copy", "take.words", "take.time", *keep)
    takes = takes.orderBy("time", "source", "copy", "doc_id", *keep)
    # the upper bits are the range's number, the lower 33 the place in it
    takes = cut(takes.withColumn("_at", F.monotonically_increasing_id()))
    takes = takes.withColumn("_range", F.shiftright("_at", 33))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = takes.groupBy("_range").agg(F.count("*").alias("_n"))
    ranges = ranges.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = takes.join(F.broadcast(ranges), "_range")
    inside = F.col("_at") - F.shiftleft("_range", 33)
    return placed.select("doc_id", "source", "copy", "words", "time", (F.col("_before") + inside).alias("position"), *keep)


def mix_positions(docs: DataFrame) -> DataFrame:
    """mix_plan() of docs in which each of `takes` also has its position in the training order.

    Nulls, empty texts, repeated rows and an empty table are as in mix_plan().
    """
    numbered = docs.select("doc_id", "text", "source", F.monotonically_increasing_id().alias("_row"))
    plan = cut(mix_plan(numbered, keep=["_row"]))
    take = F.struct("copy", "words", "time", "position")
    ordered = training_order(plan, ["_row"]).groupBy("_row").agg(F.array_sort(F.collect_list(take)).alias("takes"))
    nothing = F.array().cast("array<struct<copy:int,words:bigint,time:double,position:bigint>>")
    met = plan.drop("takes").join(ordered, "_row", "left")
    return met.withColumn("takes", F.coalesce("takes", nothing)).drop("_row")
