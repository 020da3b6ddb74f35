"""Exact positions, picks and running totals without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrivium.session import cut_lineage

#: Rows of a range that one task sums.
RANGE_ROWS = 1_000_000


def digest(key: Column | str, seed: int | str) -> Column:
    """Seeded md5 of a key: the stable stand-in for a random order."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")).cast("binary"))


def running_totals(
    df: DataFrame,
    *,
    partition: list[str],
    bucket: str,
    order: list[str],
    values: dict[str, Column],
    inclusive: bool = True,
    few_buckets: bool = False,
) -> DataFrame:
    """Running sums in ``partition`` order, computed bucket by bucket.

    ``bucket`` must rise with ``order`` inside a partition.  Each bucket is summed on its own and
    shifted by the total of the buckets before it, so one large partition spreads over many tasks;
    only one row per bucket meets in the small window over bucket totals.  Window and join share
    one key column, so the rows are shuffled once.  ``few_buckets`` says that the number of buckets
    is bounded by the caller; their totals are then broadcast.
    """
    key = F.struct(*partition, bucket)
    work = df.select("*", key.alias("_key"), *[value.alias(f"_v_{name}") for name, value in values.items()])
    totals = work.groupBy("_key").agg(*[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in values])
    groups = [F.col("_key").getField(c) for c in partition] or [F.lit(0)]
    before = (
        Window.partitionBy(*groups).orderBy(F.col("_key").getField(bucket)).rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        "_key", *[F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(f"_c_{name}") for name in values]
    )
    end = Window.currentRow if inclusive else -1
    inside = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    summed = work.select(
        "_key", *df.columns, *[F.coalesce(F.sum(f"_v_{name}").over(inside), F.lit(0)).alias(name) for name in values]
    )
    joined = summed.join(F.broadcast(carry) if few_buckets else carry, "_key")
    return joined.select(*df.columns, *[(F.col(name) + F.col(f"_c_{name}")).alias(name) for name in values])


def ranged_totals(df: DataFrame, *, partition: list[str], order: list[str], values: dict[str, Column], rows: int = RANGE_ROWS, **how) -> DataFrame:
    """Running sums for any number of distinct values: rows are cut into ranges of about ``rows`` rows of the whole order.

    A range is a shuffle partition, so a partition that holds much of the table spreads over many.  Which row is in which
    range depends on a sample, so the placed rows are written once before their ranges' totals are taken.
    """
    ranges = -(-df.count() // rows)
    if ranges <= 1:
        placed = df.withColumn("_range", F.lit(0))
    else:
        placed = cut_lineage(df.repartitionByRange(ranges, *partition, *order).withColumn("_range", F.spark_partition_id()))
    return running_totals(placed, partition=partition, bucket="_range", order=order, values=values, **how).drop("_range")


def exact_position(df: DataFrame, key: str, seed: int | str, name: str = "position", digits: int = 3) -> DataFrame:
    """1-based position of every row in seeded digest order of a unique key.

    The first hex ``digits`` of the digest are equal-sized, ordered buckets known without sampling;
    4096 of them by default, more digits for larger tables.
    """
    work = df.withColumn("_digest", digest(key, seed)).withColumn("_bucket", F.left("_digest", F.lit(digits)))
    out = running_totals(
        work, partition=[], bucket="_bucket", order=["_digest", key], values={name: F.lit(1).cast("long")},
        few_buckets=digits <= 4,  # at most 65536 rows of two small values
    )
    return out.drop("_digest", "_bucket")


def pick(df: DataFrame, column: str, count: int, seed: int | str) -> DataFrame:
    """``count`` distinct values of a column in seeded digest order (a top-k, not a full sort)."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return values.orderBy(digest(column, seed), column).limit(count)


def pick_exactly(df: DataFrame, column: str, count: int, seed: int | str) -> DataFrame:
    """Like :func:`pick`, failing where fewer than ``count`` values exist."""
    picked = pick(df, column, count, seed)
    if picked.count() < count:
        raise ValueError(f"fewer than {count} values of {column}")
    return picked
