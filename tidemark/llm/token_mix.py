"""Mixing sources to target weights by entropy balancing.

The mix changes the corpus as little as possible: among all document rates that give each source its target number of
words it takes the ones of least relative entropy to the corpus, where a document weighs as much as its words. The
convex dual has one unknown per source (the multiplier of its constraint on words), and the rates are exponentially
tilted, rate = exp(multiplier). Newton's method solves the dual: the words per source are summed over all documents by
Spark (map-side combined), and every step is a column expression over that table of sources, all sources at once.

Rates become whole copies by systematic rounding. The documents of a source are ordered by size and numbered in a
distributed way; document k gets floor(rate*k + 1/2) - floor(rate*(k-1) + 1/2) copies. Neighbours in that order have like
sizes, so what rounding one document up adds, the next takes away: the words taken from a source miss its target by at
most the size of its longest document, however many documents it has. Then, twice, each source gets one copy more or less
of the one document whose size is nearest to what it still misses. No document is taken more than `max_ratio` times.

Defined results: a null text has size 0; a null source is a source of its own, the last one; null ids sort first. A
source of size 0 has target 0. Repeated rows are documents of their own. Ties of size are broken by doc_id and then by
the rest of the row, and equal rows by where they were read, so reruns agree on every doc_id. An empty table gives no
rows. Further columns are not read and do not clash: only doc_id, text and source are taken from the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import table
from tidemark.operators.keys import number_rows
from tidemark.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = [5.0, 2.0, 1.0]  # fixed value of the query, repeating over the sources in order
MAX_RATIO = 3.0  # fixed value of the query
NEWTON_STEPS = 64
CORRECTIONS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: list[float], max_ratio: float) -> DataFrame:
    """Adds target to one row per source (source, size): shares of the total by weight, none above max_ratio * size.

    Capping the sources with the smallest max_ratio*size/weight first and sharing the rest by weight is where repeated
    resharing ends. A source is capped if the level (words per weight) that the sources not yet capped would get
    reaches its own ratio.
    """
    everything = Window.partitionBy(F.lit(0))
    by_source = everything.orderBy(F.col("source").asc_nulls_last())
    by_ratio = everything.orderBy("__ratio", F.col("source").asc_nulls_last())
    position = (F.row_number().over(by_source) - 1) % len(weights)
    weighed = sizes.withColumn("__weight", F.element_at(F.array(*map(F.lit, weights)), position + 1)).withColumn(
        "__ratio", F.col("size") * max_ratio / F.col("__weight")
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total, all_weights = F.sum("size").over(everything), F.sum("__weight").over(everything)
    left = total - F.coalesce(F.sum(F.col("size") * max_ratio).over(before), F.lit(0.0))
    level = left / (all_weights - F.coalesce(F.sum("__weight").over(before), F.lit(0.0)))
    leveled = weighed.withColumn("__level", level).withColumn("__capped", F.col("__level") >= F.col("__ratio"))
    # Of the sources that are not capped, the first in order has the level that all of them get; later ones fall.
    final = F.max(F.when(~F.col("__capped"), F.col("__level"))).over(everything)
    return leveled.withColumn("__final", final).select(
        "source",
        F.col("size").alias("source_size"),
        F.when(F.col("__capped"), F.col("size") * max_ratio)
        .otherwise(F.col("__weight") * F.col("__final"))
        .alias("target"),
    )


def newton_rates(targets: DataFrame, max_ratio: float, steps: int = NEWTON_STEPS) -> DataFrame:
    """Adds rate = exp(multiplier): the minimum of the dual size * exp(m) - target * m of each source, by Newton.

    From m = 0 the step is -gradient/curvature = target/(size * exp(m)) - 1. After the first step m is at or above the
    solution, and from there the steps fall to it and double their digits each.
    """
    start = F.lit(0.0)
    goal = F.col("target") / F.col("source_size")
    multiplier = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, lambda m, _: m + goal * F.exp(-m) - 1)
    rate = F.when(F.col("source_size") * F.col("target") > 0, F.least(F.exp(multiplier), F.lit(max_ratio)))
    return targets.withColumn("rate", F.coalesce(rate, F.lit(0.0)))


def mix_sources(docs: DataFrame, weights: list[float] = WEIGHTS, max_ratio: float = MAX_RATIO) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken."""
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    sources = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("__docs"))
    sources = materialize(sources)  # one row per source
    rates = newton_rates(source_targets(sources.drop("__docs"), weights, max_ratio), max_ratio)
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_first())
    starts = sources.select(
        F.col("source").alias("__source"), (F.sum("__docs").over(before) - F.col("__docs")).alias("__before")
    )
    known = rates.join(starts, F.col("source").eqNullSafe(F.col("__source"))).drop("source")
    numbered = number_rows(sized, ["source", "size", "doc_id"], name="__n")
    placed = numbered.join(known, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    k = F.col("__n") - F.col("__before")
    copies = F.floor(F.col("rate") * k + 0.5) - F.floor(F.col("rate") * (k - 1) + 0.5)
    rounded = materialize(placed.withColumn("copies", copies).drop("__before"))
    for _ in range(CORRECTIONS):
        rounded = nearer(rounded, max_ratio)
    return rounded.select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def nearer(rounded: DataFrame, max_ratio: float) -> DataFrame:
    """Adds or takes away one copy of one document per source: the one whose size is nearest to what the source misses.

    One aggregate with map-side combining finds the misses, another the documents, one row per source each.
    """
    missing = rounded.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("__missing")
    )
    missing = materialize(missing.withColumnRenamed("source", "__source"))
    beside = rounded.join(missing, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    step = F.signum("__missing").cast("bigint")
    free = (F.col("copies") + step >= 0) & (F.col("copies") + step <= max_ratio) & (F.col("size") > 0)
    off = F.abs(F.abs("__missing") - F.col("size"))
    best = beside.filter(free & (off < F.abs("__missing"))).groupBy("source").agg(
        F.min(F.struct(off.alias("off"), F.col("__n").alias("n"), step.alias("step"))).alias("__best")
    )
    best = materialize(best.select("__best.n", "__best.step"))
    changed = rounded.join(best, F.col("__n") == F.col("n"), "left")
    return changed.withColumn("copies", F.col("copies") + F.coalesce("step", F.lit(0))).drop("n", "step")


def op8_mix_to_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
