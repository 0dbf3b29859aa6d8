"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

A source whose share of the text is to become its target is repeated target/share times on average.
Each document draws its number of copies from a Poisson distribution with that mean, by inverting
the distribution at a number that a hash of its id gives, so a rerun draws the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fresh, partitions

# Hash digits in a uniform number: 52 bits, all of which a double holds.
DIGITS = 13


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts, joined by colons; a null counts as 'null'."""
    key = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("long") / F.lit(float(16**DIGITS))


def poisson_steps(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... as an array that ends where nothing is left in a double.

    Made of logarithms, so that a large mean does not underflow.
    """
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    logs = lambda k: F.when(k == 0, F.lit(0.0)).otherwise(F.log(k.cast("double")))
    start = F.struct(F.array().cast("array<double>").alias("steps"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("logs"))

    def add(so_far: Column, k: Column) -> Column:
        factorial = so_far["logs"] + logs(k)
        total = so_far["sum"] + F.exp(k * F.log(mean) - mean - factorial)
        return F.struct(
            F.concat(so_far["steps"], F.array(total)).alias("steps"), total.alias("sum"), factorial.alias("logs")
        )

    steps = F.aggregate(F.sequence(F.lit(0), last), start, add, lambda s: s["steps"])
    return F.when(mean > 0, steps).otherwise(F.array(F.lit(1.0)))


def rates(docs: DataFrame, targets: dict[str, float], source: str = "source", text: str = "text") -> DataFrame:
    """``(mixed, rate)``: mean copies of a document of each target source, and of all others
    (``mixed`` null), so that the expected characters have the target shares and the same total.

    What the targets leave of 1 goes to the other sources together, in their own proportions. Has at
    most ``len(targets) + 1`` rows, and the count is pre-aggregated, so a hot source is no hot task.
    """
    if not targets or min(targets.values()) < 0 or sum(targets.values()) > 1 + 1e-9:
        raise ValueError("targets must be at least 0 and sum to 1 at most")
    size = F.coalesce(F.length(text), F.lit(0)).cast("long")
    mixed = F.when(F.col(source).isin(*targets), F.col(source)).alias("mixed")
    sizes = docs.select(mixed, size.alias("size")).groupBy("mixed").agg(F.sum("size").alias("size"))
    wanted = F.lit(max(0.0, 1 - math.fsum(targets.values())))
    for name, share in targets.items():
        wanted = F.when(F.col("mixed") == name, F.lit(share)).otherwise(wanted)
    total = sizes.agg(F.sum("size")).scalar()
    rate = F.when(F.col("size") > 0, wanted * total / F.col("size")).otherwise(F.lit(1.0))
    return sizes.select("mixed", rate.alias("rate"))


def mix_sources(
    docs: DataFrame,
    targets: dict[str, float],
    seed: str,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Every document as often as its Poisson number says, in a global random order.

    Returns the columns of ``docs``, ``copy`` (1, 2, ...) and ``shuffle_key``; the rows are laid in
    ascending ``shuffle_key`` over the partitions and within each. A document that draws 0 has no
    row: that is the operator's feature. Null and unlisted sources count as one "other" source. A source
    without any character keeps its documents with mean 1. Null keys draw alike; repeated rows draw the same number each.
    Columns that ``docs`` has already by the new names keep them and the new ones get underscores.
    An empty table stays empty.
    """
    copy, order = fresh(docs, "copy"), fresh(docs, "shuffle_key")
    steps, mixed = fresh(docs, "steps"), fresh(docs, "mixed")
    table = rates(docs, targets, source, text).select(
        F.col("mixed").alias(mixed), poisson_steps(F.col("rate")).alias(steps)
    )
    own = F.when(F.col(source).isin(*targets), F.col(source))
    drawn = F.size(F.filter(F.col(steps), lambda p: p <= uniform(F.lit(seed), F.col(key))))
    laid = docs.join(F.broadcast(table), own.eqNullSafe(F.col(mixed)))
    laid = laid.withColumn(steps, drawn).where(F.col(steps) > 0)
    laid = laid.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(steps)))).drop(steps, mixed)
    place = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col(copy), F.lit("order"))
    laid = laid.withColumn(order, F.md5(place))
    # Hash digits are uniform: their ranges are known without sampling the rows.
    n = partitions(docs.sparkSession)
    at = F.conv(F.substring(F.col(order), 1, DIGITS), 16, 10).cast("long") / F.lit(float(16**DIGITS))
    return laid.repartitionById(n, F.floor(at * n).cast("int")).sortWithinPartitions(order)
