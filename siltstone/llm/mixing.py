"""Mixing sources to target weights by capped water-filling.

Each source gets a share of the words by its weight, but never more than
max_epochs times its own size; what a clamped source can't take is shared again
by weight among the others. The level that this ends at is found in closed form
from the sources sorted by size over weight. Documents are then taken
floor(target / size) whole times, and the fraction that is left by one more
repetition of the documents that come first in a seeded order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import WORD, stash, table

#: Leading bits of a document's place in the seeded order: a source's running total goes over 2**BITS slices first.
BITS = 12


def n_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: DataFrame, max_epochs: float = 3.0, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """Adds target to a table (source, source_size) of one row per source.

    Weights repeat over the sources in code point order, null last. Sources
    stop at max_epochs times their size, the excess goes to the others by
    weight until none is above; if all stop, targets add up to less than the
    whole. Windows over all sources run in one task: a row per source, not per
    document.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("_w", w.cast("double")).withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
    rising = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before, onward = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    # If this source is the first that doesn't stop, the level is what the sources before it leave, by the weights from it on.
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(onward)
    found = weighed.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_cap"))
    level = F.min_by("_level", F.when(F.col("_open"), F.col("_cap") / F.col("_w"))).over(every)
    return found.withColumn("target", F.least(F.col("_cap"), F.coalesce(level * F.col("_w"), F.col("_cap")))).drop("_w", "_cap", "_level", "_open")


def place(seed: int):
    """A document's place in the seeded order, 0 to 2**63 - 1, by its doc_id and text."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 1)


def _few(sources: DataFrame, most: int = 20_000) -> bool:
    """Whether a table of a row per source is small enough to broadcast; counts at most one row over the bound."""
    return sources.limit(most + 1).count() <= most


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows and what the plan says of their source, as the struct plan."""
    own = plan.select(F.coalesce("source", F.lit("")).alias("_name"), F.col("source").isNull().alias("_none"), F.struct(*[c for c in plan.columns if c != "source"]).alias("plan"))
    own = F.broadcast(own) if _few(plan) else own
    keyed = rows.withColumns({"_name": F.coalesce("source", F.lit("")), "_none": F.col("source").isNull()})
    return keyed.join(own, ["_name", "_none"]).drop("_name", "_none")


def plan_of(sized: DataFrame, max_epochs: float, weights: tuple[float, ...], bits: int = BITS) -> DataFrame:
    """One row per source: source, source_size, target, whole, cutoff, swap.

    A document is taken `whole` times, and once more if its place is below
    cutoff, or, at the place swap, if it isn't. Running totals go over a table
    of at most 2**bits rows a source and then over the documents of the one
    slice that the end falls into, so a source that holds most rows is summed
    by many tasks, and ranks a 2**bits-th of it in one.
    """
    width = 63 - bits
    by_slice = stash(sized.groupBy("source", F.shiftright("place", width).alias("slice")).agg(F.sum("size").alias("n")), "slices")
    targets = water_fill(by_slice.groupBy("source").agg(F.sum("n").alias("source_size")), max_epochs, weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    targets = targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = stash(targets, "targets")
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = by_slice.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0)))
    cut = _with_plan(cut, targets).where((F.col("before") < F.col("plan.rest")) & (F.col("before") + F.col("n") >= F.col("plan.rest")))
    cut = stash(cut.select("source", F.col("slice").alias("cut"), "before", F.col("plan.rest").alias("rest")), "cut")

    inside = _with_plan(sized.select("source", "place", "size"), cut).where(F.shiftright("place", width) == F.col("plan.cut"))
    upto = Window.partitionBy("source").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("at", F.col("plan.before") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
    taken = F.col("at") + F.col("size") / 2 < F.col("plan.rest")
    ends = inside.groupBy("source").agg(F.min(F.when(~taken, F.col("place"))).alias("first_out"), F.max(F.col("plan.cut")).alias("cut"))
    cutoff = F.coalesce("first_out", F.when(F.col("cut") + 1 < 1 << bits, F.shiftleft(F.col("cut") + 1, width)).otherwise(F.lit((1 << 63) - 1)))
    ends = stash(ends.select("source", cutoff.alias("cutoff")), "ends")
    targets = _with_plan(targets, ends.unionByName(targets.join(ends.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left_anti").select("source", F.lit(0).cast("long").alias("cutoff"))))
    targets = stash(targets.select("source", "source_size", "target", "whole", "rest", F.col("plan.cutoff").alias("cutoff")), "planned")

    below = F.col("place") < F.col("plan.cutoff")
    sums = _with_plan(sized.select("source", "place", "size"), targets).groupBy("source").agg((F.first("plan.rest") - F.sum(F.when(below, F.col("size")).otherwise(0))).alias("gap"), F.first("plan.cutoff").alias("cutoff"))
    each = _with_plan(sized.select("source", "place", "size"), stash(sums, "gaps"))
    change = F.when(F.col("plan.gap") > 0, F.col("size")).otherwise(-F.col("size"))
    left = F.abs(F.col("plan.gap") - change)
    may = (F.col("size") > 0) & ((F.col("plan.gap") > 0) != below) & (left < F.abs("plan.gap"))
    swap = each.where(may).groupBy("source").agg(F.min(F.struct(left.alias("left"), "place")).getField("place").alias("swap"))
    swap = swap.withColumnRenamed("source", "s")
    return stash(targets.join(swap, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "whole", "cutoff", "swap"), "plan")


def times():
    """How often a document is taken by the plan of its source, its place and size."""
    extra = (F.col("place") < F.col("plan.cutoff")) != F.coalesce(F.col("place") == F.col("plan.swap"), F.lit(False))
    return F.when(F.col("size") > 0, F.col("plan.whole") + extra.cast("int")).otherwise(0).cast("int")


def sizes(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), place(seed).alias("place"))


def mix(docs: DataFrame, max_epochs: float = 3.0, weights: tuple[float, ...] = (1.0, 2.0, 3.0), seed: int = 42) -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target, times (whole repetitions), taken (times * size).

    Null texts and texts without words have size 0 and are taken zero times. A
    null source is a source. Repeated rows (the same doc_id and text) have the
    same place and are taken alike; each counts. An empty table gives an empty
    result. Other columns are not read.

    The extra repetition goes to documents in a seeded order, as long as the
    middle of a document lies below what is left, so a source ends within half
    a document of its target; one document is then added or left out, the one
    that closes most of the gap.
    """
    sized = stash(sizes(docs, seed), "sized")
    out = _with_plan(sized, plan_of(sized, max_epochs, weights)).withColumn("times", times())
    return out.select("doc_id", "source", "size", F.col("plan.source_size").alias("source_size"), F.col("plan.target").alias("target"), "times", (F.col("times") * F.col("size")).alias("taken"))


def repeat_docs(docs: DataFrame, max_epochs: float = 3.0, weights: tuple[float, ...] = (1.0, 2.0, 3.0), seed: int = 42) -> DataFrame:
    """docs with each row repeated as often as the mix takes it. All columns stay; documents of no words go. Texts are not shuffled: each row is decided by the plan of its source."""
    plan = plan_of(stash(sizes(docs, seed), "sized"), max_epochs, weights)
    rows = docs.select("source", n_words(F.col("text")).alias("size"), place(seed).alias("place"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = _with_plan(rows, plan).select("row", times().alias("times")).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "times")
