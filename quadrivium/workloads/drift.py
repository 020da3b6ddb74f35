"""Drift methods and density clustering on the embedding and text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.operators import cluster, score
from quadrivium.plans import drift
from quadrivium.workloads import tables as t

SHIFT = 0.15  # moves the unit vectors off the origin, so that the smallest cosine is positive
EPS = 1.18  # at the default radius all of these vectors are noise


def _train(spark, sf):
    return t.read(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double") + SHIFT).alias("v")
    )


def _test(spark, sf):
    return t.read(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform(F.reverse("embedding"), lambda x: x.cast("double") + SHIFT).alias("v")
    )


def _rounded(df, *columns):
    return df.select(*[F.round(c, 6).alias(c) if c in columns else F.col(c) for c in df.columns])


def drift_thresholds_batch(spark, sf):
    return _rounded(drift.thresholds(_train(spark, sf), "id", "v"), "minimum", "upper", "lower")


def drift_thresholds_global(spark, sf):
    return _rounded(drift.thresholds(_train(spark, sf), "id", "v", scope="global"), "minimum", "upper", "lower")


def drift_thresholds_negative(spark, sf):
    """Unshifted vectors: the minimum is negative and the band is empty."""
    raw = t.read(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    limits = drift.thresholds(raw, "id", "v")
    return _rounded(limits, "minimum", "upper", "lower").withColumn("empty_band", F.col("upper") <= F.col("lower"))


def _similar(spark, sf):
    return drift.min_similarity(_train(spark, sf), _test(spark, sf), "id", "v")


def min_similarity(spark, sf):
    return _rounded(_similar(spark, sf), "similarity")


def drift_band(spark, sf):
    limits = drift.thresholds(_train(spark, sf), "id", "v")
    return _rounded(drift.band_drift(_similar(spark, sf), limits), "similarity")


def drift_flag(spark, sf):
    limits = drift.thresholds(_train(spark, sf), "id", "v")
    return drift.drift_flag(drift.band_drift(_similar(spark, sf), limits))


def _history(spark, sf):
    return t.read(spark, sf, "events").where("event_type = 'error'").select(
        F.col("event_id").cast("string").alias("query"), F.col("value").alias("distance"), F.col("ts").alias("timestamp")
    )


def _latest(spark, sf):
    return t.read(spark, sf, "events").agg(F.max("ts")).scalar()


def drift_trend(spark, sf):
    return drift.trend(_history(spark, sf), _latest(spark, sf), F.lit("2024-01-02 00:00:00").cast("timestamp"))


def drift_trend_queries(spark, sf):
    return drift.trend_window(_history(spark, sf), _latest(spark, sf)).select("query", "distance")


def drift_mean_distance(spark, sf):
    return _rounded(drift.distance_drift(_train(spark, sf), _test(spark, sf), "id", "v"), "mean_distance")


def drift_mean_distance_share(spark, sf):
    points = drift.distance_drift(_train(spark, sf), _test(spark, sf), "id", "v")
    return drift.drifted_share(points).withColumn("drifted_share", F.round("drifted_share", 6))


def mean_pair_distance(spark, sf):
    return _rounded(drift.mean_pair_distance(_train(spark, sf), "id", "v"), "mean_distance")


def drift_text_properties(spark, sf):
    documents, turns = t.read(spark, sf, "documents"), t.read(spark, sf, "conversations")
    return _rounded(drift.property_drift(documents, turns, "text"), "drift_score")


def distinct_queries(spark, sf):
    return drift.distinct_queries(t.read(spark, sf, "documents"), "text").select(F.md5(F.col("query").cast("binary")).alias("query_md5"))


def dbscan_core_points(spark, sf):
    counts = cluster.neighbour_counts(_train(spark, sf), "id", "v", EPS)
    return counts.withColumn("is_core", F.col("neighbours") >= C.DBSCAN_MIN_SAMPLES)


def _clusters(spark, sf):
    return cluster.dbscan(_train(spark, sf), "id", "v", EPS)


def dbscan_labels(spark, sf):
    return _clusters(spark, sf).select("key", "label", "is_core")


def nearest_core(spark, sf):
    return _rounded(cluster.assign_to_clusters(_test(spark, sf), _clusters(spark, sf), "id", "v", EPS), "distance")


def dbscan_string_keys(spark, sf):
    """Clusters of points with string keys; every fiftieth point has no vector and is noise."""
    points = _train(spark, sf).select(
        F.lpad(F.col("id").cast("string"), 12, "0").alias("id"), F.when(F.col("id") % 50 != 7, F.col("v")).alias("v")
    )
    return cluster.dbscan(points, "id", "v", EPS).select("key", "label", "is_core")


def nearest_core_ties(spark, sf):
    """Points halfway between two core points that are equally near: the smaller key gives the label."""
    core = t.read(spark, sf, "part").where("p_partkey % 2 = 0").select(
        F.col("p_partkey").alias("key"), F.array(F.col("p_partkey").cast("double"), F.lit(0.0)).alias("vector"),
        (-F.col("p_partkey")).alias("label"), F.lit(True).alias("is_core"),
    )
    points = t.read(spark, sf, "part").where("p_partkey % 2 = 1").select(
        F.col("p_partkey").alias("id"), F.array(F.col("p_partkey").cast("double"), F.lit(0.5)).alias("v")
    )
    return _rounded(cluster.assign_to_clusters(points, core, "id", "v", 2.0), "distance")


def density_drift(spark, sf):
    return _rounded(
        drift.density_drift(_train(spark, sf), _test(spark, sf), "id", "v", EPS), "train_noise_share", "test_noise_share"
    )


def text_embedding(spark, sf):
    """Hashed word vectors of whole documents: their size, length and a digest of all components."""
    rows = score.embed(t.read(spark, sf, "documents"), "text", "vector", 256)
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    parts = F.transform("vector", lambda x: F.round(x * 1_000_000).cast("long").cast("string"))
    return rows.select(
        "doc_id", F.size("vector").alias("dim"), F.round(F.sqrt(square), 4).alias("norm"),
        F.md5(F.array_join(parts, ",").cast("binary")).alias("vector_md5"),
    )


QUERIES = {
    f.__name__: f
    for f in [
        drift_thresholds_batch, drift_thresholds_global, drift_thresholds_negative, min_similarity, drift_band, drift_flag,
        drift_trend, drift_trend_queries, drift_mean_distance, drift_mean_distance_share, mean_pair_distance,
        drift_text_properties, distinct_queries, dbscan_core_points, dbscan_labels, nearest_core, dbscan_string_keys,
        nearest_core_ties, density_drift, text_embedding,
    ]
}

_VECTORS = f"""train AS (SELECT vec_id AS id, list_transform(embedding::DOUBLE[], lambda x: x + {SHIFT}) AS v FROM embeddings),
test AS (SELECT vec_id AS id, list_transform(list_reverse(embedding)::DOUBLE[], lambda x: x + {SHIFT}) AS v FROM embeddings)"""


def _batches(source: str) -> str:
    return f"""placed AS (SELECT id, v, (row_number() OVER (ORDER BY md5(id || '#{C.SPLIT_SEED}'), id) - 1) // {C.THRESHOLD_BATCH} AS b FROM {source}),
limits AS (SELECT min(list_cosine_similarity(x.v, y.v)) AS m FROM placed x JOIN placed y ON x.b = y.b)"""


_LIMITS = "SELECT round(m, 6) AS minimum, round(m - m * 0.1, 6) AS upper, round(m - m * 0.6, 6) AS lower"
_SIMILAR = "similar_ AS (SELECT a.id AS key, min(list_cosine_similarity(a.v, b.v)) AS similarity FROM test a CROSS JOIN train b GROUP BY a.id)"
_BAND = "band AS (SELECT key, similarity FROM similar_, limits WHERE similarity < m - m * 0.1 AND similarity > m - m * 0.6)"
_MEAN = """mean_ AS (SELECT sum(list_distance(a.v, b.v)) / count(*) AS limit_ FROM train a CROSS JOIN train b),
means AS (SELECT a.id AS key, avg(list_distance(a.v, b.v)) AS mean_distance FROM test a CROSS JOIN train b GROUP BY a.id),
points AS (SELECT key, mean_distance, mean_distance >= limit_ AS drifted FROM means, mean_)"""
_CLUSTERS = f"""near AS (SELECT a.id AS a, b.id AS b FROM train a CROSS JOIN train b WHERE list_distance(a.v, b.v) <= {EPS}),
counts AS (SELECT a AS key, count(*) AS neighbours FROM near GROUP BY a),
core AS (SELECT key FROM counts WHERE neighbours >= {C.DBSCAN_MIN_SAMPLES}),
links AS (SELECT a, b FROM near WHERE a IN (SELECT key FROM core) AND b IN (SELECT key FROM core)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
core_labels AS (SELECT a AS key, min(b) AS label FROM reach GROUP BY a),
border AS (SELECT n.a AS key, min(c.label) AS label FROM near n JOIN core_labels c ON n.b = c.key
           WHERE n.a NOT IN (SELECT key FROM core) GROUP BY n.a),
labelled AS (SELECT t.id AS key, coalesce(c.label, b.label) AS label, c.key IS NOT NULL AS is_core
             FROM train t LEFT JOIN core_labels c ON t.id = c.key LEFT JOIN border b ON t.id = b.key)"""
_NEAREST = f"""nearest AS (
  SELECT a.id AS key, list_distance(a.v, b.v) AS distance, c.label,
         row_number() OVER (PARTITION BY a.id ORDER BY round(list_distance(a.v, b.v), 12), b.id) AS n
  FROM test a CROSS JOIN train b JOIN core_labels c ON b.id = c.key),
assigned AS (SELECT key, CASE WHEN distance <= {EPS} THEN label END AS label, distance FROM nearest WHERE n = 1)"""

_tokens = "list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda w: w <> '')"
_special = "length(regexp_replace(text, '[\\p{L}\\p{N}\\s\\x0b!-/:-@\\[-`{-~]', '', 'g'))"


def _properties(source: str, flag: int) -> str:
    share = "CASE WHEN {1} > 0 THEN {0} / CAST({1} AS DOUBLE) ELSE 0.0 END"
    inner = f"SELECT text, length(text) AS n, {_tokens} AS w FROM {source}"
    parts = {
        "text_length": "CAST(n AS DOUBLE)",
        "mean_word_length": share.format("list_sum(list_transform(w, lambda x: length(x)))", "len(w)"),
        "max_word_length": "CAST(coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS DOUBLE)",
        "punctuation_share": share.format(f"(n - length({t.sql_plain('text')}))", "n"),
        "special_share": share.format(_special, "n"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS property, CAST({value} AS DOUBLE) AS x, {flag} AS is_test FROM ({inner})" for name, value in parts.items()
    )


_NOW = "(SELECT max(ts) FROM events)"

SQL = {
    "drift_thresholds_batch": t.with_(_VECTORS, _batches("train")) + _LIMITS + " FROM limits",
    "drift_thresholds_global": t.with_(_VECTORS)
    + ", limits AS (SELECT min(list_cosine_similarity(a.v, b.v)) AS m FROM train a CROSS JOIN train b) " + _LIMITS + " FROM limits",
    "drift_thresholds_negative": t.with_("raw AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings)", _batches("raw"))
    + _LIMITS + ", m - m * 0.1 <= m - m * 0.6 AS empty_band FROM limits",
    "min_similarity": t.with_(_VECTORS, _SIMILAR) + "SELECT key, round(similarity, 6) AS similarity FROM similar_",
    "drift_band": t.with_(_VECTORS, _batches("train"), _SIMILAR, _BAND) + "SELECT key, round(similarity, 6) AS similarity FROM band",
    "drift_flag": t.with_(_VECTORS, _batches("train"), _SIMILAR, _BAND)
    + "SELECT count(*) AS drifted_rows, count(*) > 0 AS data_drift FROM band",
    "drift_trend": f"""SELECT count(*) AS rows_in_window, count(*) >= 2 AS trend FROM events
        WHERE event_type = 'error' AND ts > greatest({_NOW} - INTERVAL 7 DAY, TIMESTAMP '2024-01-02 00:00:00')""",
    "drift_trend_queries": f"""SELECT CAST(event_id AS VARCHAR) AS query, value AS distance FROM events
        WHERE event_type = 'error' AND ts > {_NOW} - INTERVAL 7 DAY""",
    "drift_mean_distance": t.with_(_VECTORS, _MEAN) + "SELECT key, round(mean_distance, 6) AS mean_distance, drifted FROM points",
    "drift_mean_distance_share": t.with_(_VECTORS, _MEAN) + "SELECT round(avg(CAST(drifted AS DOUBLE)), 6) AS drifted_share FROM points",
    "mean_pair_distance": t.with_(_VECTORS, _MEAN) + "SELECT round(limit_, 6) AS mean_distance FROM mean_",
    "drift_text_properties": f"""
        WITH p AS ({_properties('documents', 0)} UNION ALL {_properties('conversations', 1)}),
        g AS (SELECT property, x, sum(1 - is_test) AS a, sum(is_test) AS b FROM p GROUP BY property, x),
        c AS (SELECT property, sum(a) OVER (PARTITION BY property ORDER BY x) / sum(a) OVER (PARTITION BY property)
                   - sum(b) OVER (PARTITION BY property ORDER BY x) / sum(b) OVER (PARTITION BY property) AS gap FROM g)
        SELECT property, round(max(abs(gap)), 6) AS drift_score, max(abs(gap)) >= {C.PROPERTY_DRIFT} AS drifted FROM c GROUP BY property""",
    "distinct_queries": "SELECT DISTINCT md5(text) AS query_md5 FROM documents",
    "text_embedding": f"""
        WITH w AS (SELECT doc_id, md5(w) AS h FROM (SELECT doc_id, unnest({t.sql_words('text')}) AS w FROM documents)),
        c AS (SELECT doc_id, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % 256 AS k,
                     sum(CASE WHEN CAST(('0x' || substr(h, 9, 1)) AS BIGINT) % 2 = 1 THEN -1 ELSE 1 END) AS x FROM w GROUP BY ALL),
        n AS (SELECT doc_id, sqrt(sum(CAST(x * x AS DOUBLE))) AS size FROM c GROUP BY doc_id),
        v AS (SELECT d.doc_id, d.k, CASE WHEN n.size > 0 THEN coalesce(c.x, 0) / n.size ELSE 0 END AS y
              FROM (SELECT doc_id, unnest(range(256)) AS k FROM documents) d LEFT JOIN c ON c.doc_id = d.doc_id AND c.k = d.k LEFT JOIN n ON n.doc_id = d.doc_id)
        SELECT doc_id, CAST(count(*) AS INT) AS dim, round(sqrt(sum(y * y)), 4) AS norm,
               md5(string_agg(CAST(CAST(round(y * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY k)) AS vector_md5 FROM v GROUP BY doc_id""",
    "dbscan_core_points": t.with_(_VECTORS)
    + f""", near AS (SELECT a.id AS a FROM train a CROSS JOIN train b WHERE list_distance(a.v, b.v) <= {EPS})
        SELECT a AS key, count(*) AS neighbours, count(*) >= {C.DBSCAN_MIN_SAMPLES} AS is_core FROM near GROUP BY a""",
    "dbscan_labels": t.with_(_VECTORS, _CLUSTERS).replace("WITH ", "WITH RECURSIVE ", 1) + "SELECT key, label, is_core FROM labelled",
    "nearest_core": t.with_(_VECTORS, _CLUSTERS, _NEAREST).replace("WITH ", "WITH RECURSIVE ", 1)
    + "SELECT key, label, round(distance, 6) AS distance FROM assigned",
    "dbscan_string_keys": t.with_(
        _VECTORS, _CLUSTERS.replace("train", "keyed").replace("FROM keyed t", "FROM every t")).replace("near AS (", """every AS (
          SELECT lpad(CAST(id AS VARCHAR), 12, '0') AS id, id AS n, v FROM train), keyed AS (SELECT id, v FROM every WHERE n % 50 <> 7),
        near AS (""", 1).replace("WITH ", "WITH RECURSIVE ", 1) + "SELECT key, label, is_core FROM labelled",
    "nearest_core_ties": """
        SELECT p.p_partkey AS key, -CASE WHEN l.k IS NULL THEN r.k ELSE l.k END AS label, round(sqrt(1.25), 6) AS distance
        FROM part p LEFT JOIN (SELECT p_partkey AS k FROM part WHERE p_partkey % 2 = 0) l ON l.k = p.p_partkey - 1
        LEFT JOIN (SELECT p_partkey AS k FROM part WHERE p_partkey % 2 = 0) r ON r.k = p.p_partkey + 1
        WHERE p.p_partkey % 2 = 1""",
    "density_drift": t.with_(_VECTORS, _CLUSTERS, _NEAREST).replace("WITH ", "WITH RECURSIVE ", 1)
    + """SELECT round((SELECT avg(CAST(label IS NULL AS DOUBLE)) FROM labelled), 6) AS train_noise_share,
        round((SELECT avg(CAST(label IS NULL AS DOUBLE)) FROM assigned), 6) AS test_noise_share""",
}
