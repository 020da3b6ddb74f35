"""Splits, JSON records and overlap scores on dialogue turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.plans import evaluation, training
from quadrivium.workloads import tables as t


def train_eval_split(spark, sf):
    return training.split_rows(t.dialogue(spark, sf), "id").select("id", "position", "part")


def order_split(spark, sf):
    """The same split over every order."""
    rows = t.read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return training.split_rows(rows, "o_orderkey").select("o_orderkey", "position", "part")


def evaluation_rows(spark, sf):
    return training.evaluation_rows(training.split_rows(t.dialogue(spark, sf), "id"), C.EVALUATION_ROWS).select("id", "query")


def evaluation_rows_whole(spark, sf):
    """Every test row."""
    return training.evaluation_rows(training.split_rows(t.dialogue(spark, sf), "id")).select("id", "query")


def chat_jsonl(spark, sf):
    return training.chat_jsonl(t.dialogue(spark, sf), keep=["id"], template=t.PROMPT)


def evaluation_jsonl(spark, sf):
    rows = t.dialogue(spark, sf).withColumn("context", F.repeat("response", F.lit(40)))
    return training.evaluation_jsonl(rows, keep=["id"], max_chars=C.EVALUATION_CONTEXT_CHARS)


def evaluation_jsonl_whole(spark, sf):
    """The same records with whole contexts."""
    return training.evaluation_jsonl(t.dialogue(spark, sf).withColumn("context", F.repeat("response", F.lit(40))), keep=["id"])


def _pairs(spark, sf):
    """The answer as prediction; the question and the answer with changed words as reference.  A turn without an answer has no prediction."""
    changed = F.coalesce(F.replace("response", F.lit("en"), F.lit("in")), F.lit(""))
    return t.dialogue(spark, sf).select(
        "id", F.col("response").alias("prediction"), F.concat("query", F.lit("\n"), changed).alias("reference")
    )


def rouge_n(spark, sf):
    rows = evaluation.rouge_n(_pairs(spark, sf), "id")
    return rows.select("key", "n", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "fmeasure")])


def bleu(spark, sf):
    return evaluation.bleu(_pairs(spark, sf), "id").withColumn("bleu", F.round("bleu", 6))


def bleu_smoothed(spark, sf):
    return evaluation.bleu(_pairs(spark, sf), "id", smooth=True).withColumn("bleu", F.round("bleu", 6))


def exact_match(spark, sf):
    rows = t.read(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.concat(F.lit(" \n"), F.col("text")).alias("prediction"),
        F.when(F.col("lang") == "en", F.col("text")).otherwise(F.lower("text")).alias("reference"),
    )
    return evaluation.exact_match(rows, "id")


def rouge_l_sum(spark, sf):
    return evaluation.rouge_l(_pairs(spark, sf), "id").withColumn("rouge_l", F.round("rouge_l", 6))


def rouge_l(spark, sf):
    return evaluation.rouge_l(_pairs(spark, sf), "id", summary=False).withColumn("rouge_l", F.round("rouge_l", 6))


def mean_metrics(spark, sf):
    return evaluation.mean_metrics(_pairs(spark, sf), "id").withColumn("value", F.round("value", 6))


def model_gate(spark, sf):
    """Mean price and discount of the lines by return flag, as the metrics of two models."""
    lines = t.read(spark, sf, "lineitem")

    def metrics(flag):
        rows = lines.where(F.col("l_returnflag") == flag).agg(F.avg("l_quantity").alias("q"), F.avg("l_tax").alias("x"))
        return rows.select(F.inline(F.array(
            F.struct(F.lit("bleu/mean").alias("metric"), F.col("q").alias("value")),
            F.struct(F.lit("rouge_l_sum/mean").alias("metric"), F.col("x").alias("value")),
        )))

    return evaluation.model_gate(metrics("A"), metrics("R"))


QUERIES = {
    f.__name__: f
    for f in [
        train_eval_split, order_split, evaluation_rows, evaluation_rows_whole, chat_jsonl, evaluation_jsonl, evaluation_jsonl_whole, rouge_n, bleu, bleu_smoothed, exact_match,
        rouge_l_sum, rouge_l, mean_metrics, model_gate,
    ]
}


def _split(source: str, key: str) -> str:
    return f"""split AS (SELECT *, row_number() OVER (ORDER BY md5({key} || '#29'), {key}) AS position,
  count(*) OVER () AS n FROM {source})"""


_PART = "CASE WHEN position <= ceil(0.1 * n) THEN 'test' ELSE 'train' END AS part"
_prompt = "'" + t.PROMPT.replace("'", "''").replace("{query}", "' || query || '").replace("{content}", "' || context || '") + "'"
_PAIRS = """pairs AS (
  SELECT id, response AS prediction, query || chr(10) || coalesce(replace(response, 'en', 'in'), '') AS reference FROM dialogue)"""
_GRAMS = f"""tokens AS (SELECT id, coalesce({t.sql_words('prediction')}, []) AS p, {t.sql_words('reference')} AS r FROM pairs),
orders_ AS (SELECT unnest([1, 2, 3, 4]) AS n),
pg AS (SELECT id, n, g, count(*) AS c FROM (SELECT id, n, unnest(list_transform(range(1, len(p) - n + 2), lambda i: array_to_string(list_slice(p, i, i + n - 1), ' '))) AS g FROM tokens, orders_) GROUP BY ALL),
rg AS (SELECT id, n, g, count(*) AS c FROM (SELECT id, n, unnest(list_transform(range(1, len(r) - n + 2), lambda i: array_to_string(list_slice(r, i, i + n - 1), ' '))) AS g FROM tokens, orders_) GROUP BY ALL),
both_ AS (SELECT t.id, o.n, greatest(len(t.p) - o.n + 1, 0) AS np, greatest(len(t.r) - o.n + 1, 0) AS nr,
         coalesce((SELECT sum(least(a.c, b.c)) FROM pg a JOIN rg b ON a.id = b.id AND a.n = b.n AND a.g = b.g WHERE a.id = t.id AND a.n = o.n), 0) AS m
         FROM tokens t, orders_ o)"""

# longest common subsequence: one row of the table per predicted word, prefix maxima along the reference
_LCS = """ref_words AS (SELECT id, unnest(r) AS w, unnest(range(1, len(r) + 1)) AS j FROM tokens),
pred_words AS (SELECT id, unnest(p) AS w, unnest(range(1, len(p) + 1)) AS i FROM tokens),
dp(id, i, j, v) AS (
  SELECT id, CAST(0 AS BIGINT), j, CAST(0 AS BIGINT) FROM (SELECT id, unnest(range(0, len(r) + 1)) AS j FROM tokens)
  UNION ALL
  SELECT id, i + 1, j, max(c) OVER (PARTITION BY id ORDER BY j) FROM (
    SELECT d.id, d.i, d.j, CASE WHEN r.w = p.w THEN lag(d.v) OVER (PARTITION BY d.id ORDER BY d.j) + 1 ELSE d.v END AS c
    FROM dp d JOIN pred_words p ON p.id = d.id AND p.i = d.i + 1 LEFT JOIN ref_words r ON r.id = d.id AND r.j = d.j)),
lcs AS (SELECT t.id, CASE WHEN len(any_value(t.p)) + len(any_value(t.r)) > 0
                          THEN 2.0 * max(d.v) / (len(any_value(t.p)) + len(any_value(t.r))) ELSE 0 END AS f
        FROM tokens t JOIN dp d ON t.id = d.id GROUP BY t.id)"""

# by lines: the same table for each pair of lines, one walk back through it, the union of the reference words it meets
_LCS_SUM = f"""rl AS (SELECT id, s, {t.sql_words('x')} AS w FROM (
  SELECT id, unnest(string_split(reference, chr(10))) AS x, unnest(range(len(string_split(reference, chr(10))))) AS s FROM pairs)),
pl AS (SELECT id, s, {t.sql_words('x')} AS w FROM (
  SELECT id, unnest(string_split(prediction, chr(10))) AS x, unnest(range(len(string_split(prediction, chr(10))))) AS s FROM pairs WHERE prediction IS NOT NULL)),
st AS (SELECT rl.id, rl.s, pl.s AS u, rl.w AS r, pl.w AS p FROM rl JOIN pl ON rl.id = pl.id WHERE len(rl.w) > 0 AND len(pl.w) > 0),
rw AS (SELECT id, s, u, unnest(r) AS w, unnest(range(1, len(r) + 1)) AS j FROM st),
pw AS (SELECT id, s, u, unnest(p) AS w, unnest(range(1, len(p) + 1)) AS i FROM st),
dp(id, s, u, i, j, v) AS (
  SELECT id, s, u, CAST(0 AS BIGINT), j, CAST(0 AS BIGINT) FROM (SELECT id, s, u, unnest(range(0, len(r) + 1)) AS j FROM st)
  UNION ALL
  SELECT id, s, u, i + 1, j, max(c) OVER (PARTITION BY id, s, u ORDER BY j) FROM (
    SELECT d.id, d.s, d.u, d.i, d.j,
           CASE WHEN r.w = p.w THEN lag(d.v) OVER (PARTITION BY d.id, d.s, d.u ORDER BY d.j) + 1 ELSE d.v END AS c
    FROM dp d JOIN pw p ON p.id = d.id AND p.s = d.s AND p.u = d.u AND p.i = d.i + 1
    LEFT JOIN rw r ON r.id = d.id AND r.s = d.s AND r.u = d.u AND r.j = d.j)),
step AS (SELECT d.id, d.s, d.u, d.i, d.j, r.w = p.w AS hit, d.v > e.v AS up
         FROM dp d JOIN dp e ON e.id = d.id AND e.s = d.s AND e.u = d.u AND e.i = d.i AND e.j = d.j - 1
         JOIN rw r ON r.id = d.id AND r.s = d.s AND r.u = d.u AND r.j = d.j
         JOIN pw p ON p.id = d.id AND p.s = d.s AND p.u = d.u AND p.i = d.i),
walk(id, s, u, i, j) AS (
  SELECT id, s, u, CAST(len(p) AS BIGINT), CAST(len(r) AS BIGINT) FROM st
  UNION ALL
  SELECT w.id, w.s, w.u, CASE WHEN x.hit OR x.up THEN w.i - 1 ELSE w.i END, CASE WHEN x.hit OR NOT x.up THEN w.j - 1 ELSE w.j END
  FROM walk w JOIN step x ON x.id = w.id AND x.s = w.s AND x.u = w.u AND x.i = w.i AND x.j = w.j),
met AS (SELECT DISTINCT w.id, w.s, w.j, r.w FROM walk w JOIN step x ON x.id = w.id AND x.s = w.s AND x.u = w.u AND x.i = w.i AND x.j = w.j
        JOIN rw r ON r.id = w.id AND r.s = w.s AND r.u = w.u AND r.j = w.j WHERE x.hit),
have AS (SELECT id, w, count(*) AS c FROM (SELECT id, unnest(p) AS w FROM tokens) GROUP BY ALL),
hits AS (SELECT m.id, sum(least(m.c, h.c)) AS n FROM (SELECT id, w, count(*) AS c FROM met GROUP BY ALL) m JOIN have h ON h.id = m.id AND h.w = m.w GROUP BY m.id),
lcs AS (SELECT t.id, CASE WHEN len(t.p) > 0 AND len(t.r) > 0 THEN 2.0 * coalesce(h.n, 0) / (len(t.p) + len(t.r)) ELSE 0 END AS f
        FROM tokens t LEFT JOIN hits h ON h.id = t.id)"""


def _bleu_sql(smooth: bool, final: bool = True) -> str:
    add = "CASE WHEN n > 1 THEN 1 ELSE 0 END" if smooth else "0"
    return (t.with_(t.DIALOGUE, _PAIRS, _GRAMS) if final else "") + f"""
        , s AS (SELECT id, count(*) FILTER (WHERE m + {add} > 0 AND np > 0) AS hits,
                       sum(CASE WHEN m + {add} > 0 AND np > 0 THEN ln((m + {add}) / (np + {add})) END) AS logs,
                       max(CASE WHEN n = 1 THEN np END) AS lp, max(CASE WHEN n = 1 THEN nr END) AS lr FROM both_ GROUP BY id)
        """ + ("" if not final else """SELECT id AS key, round(CASE WHEN hits = 4 THEN exp(logs / 4 + CASE WHEN lp >= lr THEN 0 ELSE 1 - lr / lp END) ELSE 0 END, 6) AS bleu FROM s""")


SQL = {
    "train_eval_split": t.with_(t.DIALOGUE, t.ANSWERED, _split("answered", "id")) + f"SELECT id, position, {_PART} FROM split",
    "order_split": t.with_(_split("orders", "o_orderkey")) + f"SELECT o_orderkey, position, {_PART} FROM split",
    "evaluation_rows": t.with_(t.DIALOGUE, t.ANSWERED, _split("answered", "id"))
    + "SELECT id, query FROM split WHERE position <= ceil(0.1 * n) AND position <= 5",
    "evaluation_rows_whole": t.with_(t.DIALOGUE, t.ANSWERED, _split("answered", "id")) + "SELECT id, query FROM split WHERE position <= ceil(0.1 * n)",
    "chat_jsonl": t.with_(t.DIALOGUE, t.ANSWERED) + f"""
        SELECT id, CAST(json_object('systemInstruction', json_object('role', 'system', 'parts', json_array(json_object('text', '{C.SYSTEM_INSTRUCTION}'))),
          'contents', json_array(json_object('role', 'user', 'parts', json_array(json_object('text', {_prompt}))),
                                 json_object('role', 'model', 'parts', json_array(json_object('text', response))))) AS VARCHAR) AS line FROM answered""",
    "evaluation_jsonl": t.with_(t.DIALOGUE, t.ANSWERED) + """
        SELECT id, CAST(json_object('context', left(repeat(response, 40), 50000), 'instruction', query, 'reference', response) AS VARCHAR) AS line FROM answered""",
    "evaluation_jsonl_whole": t.with_(t.DIALOGUE, t.ANSWERED) + """
        SELECT id, CAST(json_object('context', repeat(response, 40), 'instruction', query, 'reference', response) AS VARCHAR) AS line FROM answered""",
    "rouge_n": t.with_(t.DIALOGUE, _PAIRS, _GRAMS) + """
        SELECT id AS key, n, round(CASE WHEN np > 0 THEN m / np ELSE 0 END, 6) AS precision, round(CASE WHEN nr > 0 THEN m / nr ELSE 0 END, 6) AS recall,
               round(CASE WHEN np + nr > 0 THEN 2 * m / (np + nr) ELSE 0 END, 6) AS fmeasure FROM both_ WHERE n <= 2""",
    "bleu": _bleu_sql(False),
    "bleu_smoothed": _bleu_sql(True),
    "rouge_l": t.with_(t.DIALOGUE, _PAIRS, _GRAMS, _LCS).replace("WITH ", "WITH RECURSIVE ", 1)
    + "SELECT id AS key, round(f, 6) AS rouge_l FROM lcs",
    "rouge_l_sum": t.with_(t.DIALOGUE, _PAIRS, _GRAMS, _LCS_SUM).replace("WITH ", "WITH RECURSIVE ", 1)
    + "SELECT id AS key, round(f, 6) AS rouge_l FROM lcs",
    "mean_metrics": t.with_(t.DIALOGUE, _PAIRS, _GRAMS, _LCS_SUM).replace("WITH ", "WITH RECURSIVE ", 1) + _bleu_sql(False, False) + f"""
        SELECT 'bleu/mean' AS metric, round(avg(CASE WHEN hits = 4 THEN exp(logs / 4 + CASE WHEN lp >= lr THEN 0 ELSE 1 - lr / lp END) ELSE 0 END), 6) AS value FROM s
        UNION ALL SELECT 'rouge_l_sum/mean', round(avg(f), 6) FROM lcs
        UNION ALL SELECT 'rouge_' || n || '/mean', round(avg(CASE WHEN np + nr > 0 THEN 2 * m / (np + nr) ELSE 0 END), 6) FROM both_ WHERE n <= 2 GROUP BY n
        UNION ALL SELECT 'exact_match/mean', round(avg(CAST(coalesce({t.sql_strip('prediction')} = {t.sql_strip('reference')}, false) AS DOUBLE)), 6) FROM pairs""",
    "exact_match": f"""SELECT doc_id AS key, CAST({t.sql_strip("' ' || chr(10) || text")} = {t.sql_strip("CASE WHEN lang = 'en' THEN text ELSE lower(text) END")} AS DOUBLE) AS exact_match FROM documents""",
    "model_gate": """
        WITH m AS (SELECT l_returnflag AS f, avg(l_quantity) AS q, avg(l_tax) AS x FROM lineitem GROUP BY 1)
        SELECT CAST(2 AS BIGINT) AS compared, a.q >= r.q AND a.x >= r.x AS deploy FROM m a, m r WHERE a.f = 'A' AND r.f = 'R'""",
}
