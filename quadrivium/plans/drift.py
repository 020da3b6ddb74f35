"""Query drift by similarity band, mean distance, density and text properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.functions import text, vectors
from quadrivium.operators import cluster, pairs
from quadrivium.operators.keyed import append_rows
from quadrivium.operators.ordering import exact_position, ranged_totals
from quadrivium.session import cut_lineage
from quadrivium.sources import schemas


def distinct_queries(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("query")).distinct()


def batch_minimum(train: DataFrame, key: str, vector: str, batch: int = C.THRESHOLD_BATCH, seed: int = C.SPLIT_SEED) -> DataFrame:
    """Smallest cosine inside batches of ``batch`` vectors, taken in seeded key order.

    A batch is one row of at most ``batch`` vectors and is reduced in place.
    """
    placed = exact_position(train.select(F.col(key).alias("key"), F.col(vector).alias("v")), "key", seed)
    batches = placed.groupBy(F.floor((F.col("position") - 1) / batch).alias("batch")).agg(F.collect_list("v").alias("vs"))
    low = F.array_min(F.transform("vs", lambda a: F.array_min(F.transform("vs", lambda b: vectors.cosine(a, b)))))
    return batches.agg(F.min(low).alias("minimum"))


def global_minimum(train: DataFrame, key: str, vector: str, **sizes: int) -> DataFrame:
    """Smallest cosine over all pairs of distinct vectors."""
    distinct = cut_lineage(pairs.distinct_vectors(train, key, vector))
    low = pairs.fold_pairs(
        distinct, distinct, pairs.MinCosine(), left_key="key", right_key="key",
        left_vector="vector", right_vector="vector", **sizes,
    )
    return low.agg(F.min("similarity").alias("minimum"))


def thresholds(train: DataFrame, key: str, vector: str, scope: str = "batch", **options) -> DataFrame:
    """One row (minimum, upper, lower).  A negative minimum gives an empty band, as in the definition."""
    low = {"batch": batch_minimum, "global": global_minimum}[scope](train, key, vector, **options)
    m = F.col("minimum")
    return low.select("minimum", (m - m * C.DRIFT_UPPER_CUT).alias("upper"), (m - m * C.DRIFT_LOWER_CUT).alias("lower"))


def min_similarity(train: DataFrame, test: DataFrame, key: str, vector: str, **sizes: int) -> DataFrame:
    """(key, similarity): smallest cosine of each test vector to any training vector; null without a vector."""
    distinct = cut_lineage(pairs.distinct_vectors(train, key, vector))
    found = pairs.fold_pairs(
        test, distinct, pairs.MinCosine(), left_key=key, right_key="key", left_vector=vector,
        right_vector="vector", **sizes,
    )
    missing = test.where(F.col(vector).isNull()).select(F.col(key).alias("key"), F.lit(None).cast("double").alias("similarity"))
    return found.withColumnRenamed("left_id", "key").unionByName(missing)


def band_drift(similarities: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows strictly inside the band."""
    upper, lower = limits.select("upper").scalar(), limits.select("lower").scalar()
    return similarities.where((F.col("similarity") < upper) & (F.col("similarity") > lower))


def drift_flag(drifted: DataFrame) -> DataFrame:
    """One row (drifted_rows, data_drift)."""
    return drifted.agg(F.count("*").alias("drifted_rows")).withColumn("data_drift", F.col("drifted_rows") > 0)


def detect(train: DataFrame, test: DataFrame, key: str, vector: str, scope: str = "batch", **sizes: int) -> DataFrame:
    """(key, similarity) of the new vectors inside the band of the training vectors."""
    return band_drift(min_similarity(train, test, key, vector, **sizes), thresholds(train, key, vector, scope))


def append_history(drifted: DataFrame, path: str, run_time) -> None:
    """Append drifted queries with one run time stamp."""
    rows = drifted.select("query", F.col("similarity").alias("distance"), F.lit(run_time).cast("timestamp").alias("timestamp"))
    append_rows(rows, path, schemas.DRIFT_HISTORY)


def trend_window(history: DataFrame, now: Column, last_detected: Column | None = None) -> DataFrame:
    """History rows after the later of seven days ago and the last detection."""
    start = now - F.expr(f"INTERVAL {C.DRIFT_WINDOW_DAYS} DAYS")
    if last_detected is not None:
        start = F.greatest(start, last_detected)
    return history.where(F.col("timestamp") > start)


def trend(history: DataFrame, now: Column, last_detected: Column | None = None) -> DataFrame:
    """One row (rows_in_window, trend)."""
    counted = trend_window(history, now, last_detected).agg(F.count("*").alias("rows_in_window"))
    return counted.withColumn("trend", F.col("rows_in_window") >= C.DRIFT_MIN_ROWS)


def retrain_decision(drifted: DataFrame, history: DataFrame, now: Column, last_detected: Column | None = None) -> DataFrame:
    """One row (drifted_rows, data_drift, trend, retrain): drift in this run and a trend before it."""
    flag = drift_flag(drifted).withColumn("trend", trend(history, now, last_detected).select("trend").scalar())
    return flag.withColumn("retrain", F.col("data_drift") & F.col("trend"))


def mean_pair_distance(train: DataFrame, key: str, vector: str, **sizes: int) -> DataFrame:
    """Mean of the full distance matrix, zero diagonal included; copies are weighted."""
    return _mean_distance(cut_lineage(pairs.distinct_vectors(train.where(F.col(vector).isNotNull()), key, vector)), **sizes)


def _mean_distance(distinct: DataFrame, **sizes: int) -> DataFrame:
    sums = pairs.fold_pairs(
        distinct, distinct, pairs.DistanceSum(), left_key="key", right_key="key", left_vector="vector",
        right_vector="vector", right_payload="copies", **sizes,
    )
    weighted = sums.join(distinct.select(F.col("key").alias("left_id"), "copies"), "left_id")
    n = F.sum("copies")
    return weighted.agg((F.sum(F.col("total") * F.col("copies")) / (n * n)).alias("mean_distance"))


def distance_drift(train: DataFrame, test: DataFrame, key: str, vector: str, **sizes: int) -> DataFrame:
    """(key, mean_distance, drifted): points at least as far from training as training is from itself.

    A point without a vector has neither.
    """
    distinct = cut_lineage(pairs.distinct_vectors(train.where(F.col(vector).isNotNull()), key, vector))
    sums = pairs.fold_pairs(
        test, distinct, pairs.DistanceSum(), left_key=key, right_key="key", left_vector=vector,
        right_vector="vector", right_payload="copies", **sizes,
    )
    n = distinct.agg(F.sum("copies").alias("n")).scalar()
    # one number; made on its own, so that two folds do not hold what they move at once
    limit = cut_lineage(_mean_distance(distinct, **sizes)).scalar()
    means = sums.select(F.col("left_id").alias("key"), (F.col("total") / n).alias("mean_distance"))
    missing = test.where(F.col(vector).isNull()).select(F.col(key).alias("key"), F.lit(None).cast("double").alias("mean_distance"))
    return means.unionByName(missing).withColumn("drifted", F.col("mean_distance") >= limit)


def drifted_share(points: DataFrame) -> DataFrame:
    return points.agg(F.avg(F.col("drifted").cast("double")).alias("drifted_share"))


def density_drift(
    train: DataFrame, test: DataFrame, key: str, vector: str, eps: float = C.DBSCAN_EPS,
    min_samples: int = C.DBSCAN_MIN_SAMPLES, **sizes: int,
) -> DataFrame:
    """One row: noise share of the training points and of the new points."""
    clusters = cluster.dbscan(train, key, vector, eps, min_samples, **sizes)
    assigned = cluster.assign_to_clusters(test, clusters, key, vector, eps, **sizes)
    return cluster.noise_share(clusters).select(
        F.col("noise_share").alias("train_noise_share"),
        cluster.noise_share(assigned).scalar().alias("test_noise_share"),
    )


def property_drift(train: DataFrame, test: DataFrame, column: str, threshold: float = C.PROPERTY_DRIFT, **ranges: int) -> DataFrame:
    """(property, drift_score, drifted): two-sample Kolmogorov-Smirnov distance per text property.

    Texts shrink to counts per distinct property value first.  The values are then summed range by range, as many
    ranges as there are values to fill them.
    """
    def long(df: DataFrame, side: str) -> DataFrame:
        rows = F.array(*[F.struct(F.lit(n).alias("property"), v.alias("value")) for n, v in text.text_properties(column).items()])
        return df.select(F.inline(rows)).select(
            "property", "value", F.lit(int(side == "train")).alias("is_train"), F.lit(int(side == "test")).alias("is_test")
        )

    counts = long(train, "train").unionAll(long(test, "test")).groupBy("property", "value").agg(
        F.sum("is_train").alias("train_rows"), F.sum("is_test").alias("test_rows")
    )
    counts = cut_lineage(counts)
    summed = ranged_totals(
        counts, partition=["property"], order=["value"],
        values={"train_below": F.col("train_rows"), "test_below": F.col("test_rows")}, **ranges,
    )
    gap = F.max_by(F.struct("train_below", "test_below"), "value")
    totals = summed.groupBy("property").agg(gap.alias("t"))
    share = F.abs(F.col("train_below") / F.col("t.train_below") - F.col("test_below") / F.col("t.test_below"))
    scores = summed.join(F.broadcast(totals), "property").groupBy("property").agg(F.max(share).alias("drift_score"))
    return scores.withColumn("drifted", F.col("drift_score") >= threshold)
