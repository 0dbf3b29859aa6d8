"""Ways to keep a hot key from becoming one task's work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SALT = "_salt"
_SALTS = "_salts"


def parts_for(spark: SparkSession) -> int:
    """Into how many pieces to think a relation cut: sixteen per shuffle partition, so that
    no piece, nor any key left whole, is more than a small part of a partition."""
    return 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(
    df: DataFrame, key: str, weight: Column | None = None, parts: int | None = None
) -> DataFrame:
    """``(key, _salts)`` of the keys that hold more than ``1/parts`` of the rows (or of
    ``weight``), with the number of pieces to cut each into.

    Shares sum to one, so there are fewer than ``parts`` such keys whatever the data. The list
    grows with the number of shuffle partitions and not with the rows: at 200,000 partitions it
    could have 3.2 million keys, some 100 MB, if nearly all rows were in keys of that size.
    """
    parts = parts or parts_for(df.sparkSession)
    weight = F.lit(1) if weight is None else weight
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(weight).alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    share = F.col("_n") * parts
    return sizes.where(share > total).select(
        key, F.greatest(F.lit(2), F.ceil(share / total)).cast("int").alias(_SALTS)
    )


def salted_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    how: str,
    heavy: DataFrame,
    spread: Sequence[str],
) -> DataFrame:
    """Equi-join of ``many`` with ``one`` (unique on ``key``) with the heavy keys split.

    Rows of a heavy key are spread by a hash of the ``spread`` columns over its pieces, and
    its single ``one`` row is repeated per piece: at most twice as many extra rows as ``heavy`` counts
    pieces in all. Rows of null key, which match nothing, are spread as well. ``how`` is
    any type that keeps each ``many`` row apart (inner, left, left_semi, left_anti). ``heavy`` has
    the bound that ``heavy_keys`` states, and is broadcast on that ground.
    """
    heavy = F.broadcast(heavy)
    hashed = F.xxhash64(*spread)
    piece = F.pmod(hashed, F.col(_SALTS)).cast("int")
    loose = F.pmod(hashed, F.lit(parts_for(many.sparkSession))).cast("int")
    salt = F.when(F.col(key).isNull(), loose).when(F.col(_SALTS).isNotNull(), piece).otherwise(0)
    salted = many.join(heavy, key, "left").withColumn(_SALT, salt).drop(_SALTS)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))
    repeated = one.join(heavy, key, "left").withColumn(_SALT, copies).drop(_SALTS)
    return salted.join(repeated, [key, _SALT], how).drop(_SALT)


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group in ``order``, numbered from 1 in ``rank``.

    Every map task passes on at most ``n`` rows of a group. Catalyst plans it so up to the session's
    limit for ``n``; above it the cut is made in two steps, the first over random pieces.
    """
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        pieces = df.withColumn(_SALT, F.pmod(F.xxhash64(*df.columns), F.lit(parts_for(df.sparkSession))))
        first = Window.partitionBy(*group, _SALT).orderBy(*order)
        df = (
            pieces.withColumn(rank, F.row_number().over(first))
            .where(F.col(rank) <= n)
            .drop(_SALT, rank)
        )
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
