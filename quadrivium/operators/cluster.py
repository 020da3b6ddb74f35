"""Density clustering of vectors: core points, labels, noise and assignment of new points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.operators import pairs
from quadrivium.session import cut_lineage

def neighbour_counts(points: DataFrame, key: str, vector: str, eps: float, **sizes: int) -> DataFrame:
    """(key, neighbours) of every distinct vector, itself and its copies included."""
    distinct = cut_lineage(pairs.distinct_vectors(points, key, vector))
    return pairs.fold_pairs(
        distinct,
        distinct,
        pairs.NeighbourCount(eps),
        left_key="key",
        right_key="key",
        left_vector="vector",
        right_vector="vector",
        right_payload="copies",
        **sizes,
    ).select(F.col("left_id").alias("key"), "neighbours")


def connected_labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(key, label): the smallest key each node is linked to.

    Alternating star contraction: every round points nodes at smaller ones and the number of rounds
    grows with the logarithm of the longest chain.  Minima are partial aggregates and the join back
    is one that adaptive execution splits at a hub with very many links.  Each round is written to
    the checkpoint folder.
    """
    edges = cut_lineage(
        links.select(F.greatest("left_id", "right_id").alias("u"), F.least("left_id", "right_id").alias("v"))
        .where("u <> v")
        .distinct()
    )

    def fingerprint(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = fingerprint(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = large.where("u <> v").distinct()
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct())
        now = fingerprint(edges)
        if now == seen:
            break
        seen = now
    return nodes.join(edges.select(F.col("u").alias("key"), "v"), "key", "left").select(
        "key", F.coalesce("v", "key").alias("label")
    )


def dbscan(
    points: DataFrame,
    key: str,
    vector: str,
    eps: float = C.DBSCAN_EPS,
    min_samples: int = C.DBSCAN_MIN_SAMPLES,
    **sizes: int,
) -> DataFrame:
    """(key, vector, label, is_core) of every point; the label, of the key's type, is null for noise.

    A cluster is named by the smallest key among its core points; a border point in reach of two
    clusters takes the smaller name.  Copies of a vector are handled once.  A point without a
    vector is noise.
    """
    distinct = cut_lineage(pairs.distinct_vectors(points, key, vector))
    counts = pairs.fold_pairs(
        distinct,
        distinct,
        pairs.NeighbourCount(eps),
        left_key="key",
        right_key="key",
        left_vector="vector",
        right_vector="vector",
        right_payload="copies",
        **sizes,
    )
    marked = cut_lineage(
        distinct.join(counts.withColumnRenamed("left_id", "key"), "key").select(
            "key", "vector", "copies", (F.col("neighbours") >= min_samples).alias("is_core")
        )
    )
    core = marked.where("is_core").select("key", "vector", "copies")
    links = pairs.fold_pairs(
        core, core, pairs.Links(eps), left_key="key", right_key="key", left_vector="vector",
        right_vector="vector", **sizes
    )
    named = cut_lineage(core.join(connected_labels(core.select("key"), links), "key"))
    rest = marked.where("not is_core")
    border = pairs.fold_pairs(
        rest, named, pairs.LowestLabel(eps), left_key="key", right_key="key", left_vector="vector",
        right_vector="vector", right_payload="label", **sizes
    ).select(F.col("left_id").alias("key"), "label")
    columns = ["key", "vector", "copies", "label", "is_core"]
    labelled = named.withColumn("is_core", F.lit(True)).select(*columns).unionByName(
        rest.join(border, "key", "left").select(*columns)
    )
    # a vector without copies is its own row; only copied vectors are looked up again
    single = labelled.where("copies = 1").drop("copies")
    copied = labelled.where("copies > 1").select("vector", "label", "is_core")
    rows = points.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    missing = rows.where(F.col("vector").isNull()).select(
        "key", "vector", F.lit(None).cast(single.schema["label"].dataType).alias("label"), F.lit(False).alias("is_core")
    )
    return single.unionByName(rows.join(copied, "vector").select(*single.columns)).unionByName(missing)


def assign_to_clusters(
    points: DataFrame, clusters: DataFrame, key: str, vector: str, eps: float = C.DBSCAN_EPS, **sizes: int
) -> DataFrame:
    """(key, label, distance): label of the nearest core point, null where it is farther than ``eps``."""
    core = cut_lineage(
        clusters.where("is_core")
        .groupBy("vector")
        .agg(F.min("key").alias("key"), F.min("label").alias("label"))
    )
    near = pairs.fold_pairs(
        points, core, pairs.NearestLabel(), left_key=key, right_key="key", left_vector=vector,
        right_vector="vector", right_payload="label", **sizes
    )
    label = F.when(F.col("distance") <= eps, F.col("label"))
    found = near.select(F.col("left_id").alias("key"), label.alias("label"), "distance")
    everyone = points.select(F.col(key).alias("key"))
    return everyone.join(found, "key", "left").select("key", "label", "distance")


def noise_share(labels: DataFrame) -> DataFrame:
    """Share of points without a cluster."""
    return labels.agg(F.avg(F.col("label").isNull().cast("double")).alias("noise_share"))
