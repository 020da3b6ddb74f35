"""Text overlap scores, rubric means and the model gate."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium.functions import replies, text
from quadrivium.session import ship_package

MAX_ORDER = 4
# Metrics a new model must not lose on.
GATE_METRICS = ["bleu/mean", "rouge_l_sum/mean"]


def _clipped(predicted: list[str], expected: list[str], order: int) -> int:
    """N-grams of one order that both lists have, each as often as in the list that has fewer of it."""
    one, other = (Counter(zip(*(side[i:] for i in range(order)))) for side in (predicted, expected))
    return sum(min(n, other[gram]) for gram, n in one.items() if gram in other)


def _matches(spark, orders: list[int]):
    """Function of two columns of words joined by blanks: clipped matches of every order, counted row by row."""
    ship_package(spark)

    @F.pandas_udf("array<bigint>")
    def count(predicted: pd.Series, expected: pd.Series) -> pd.Series:
        rows = ((p.split(), r.split()) for p, r in zip(predicted, expected))
        return pd.Series([[_clipped(p, r, n) for n in orders] for p, r in rows], dtype=object)

    return count


def gram_overlap(df: DataFrame, orders: list[int]) -> DataFrame:
    """``df`` with ``overlap``: clipped n-gram matches of its texts and both sides' n-grams, order by order.

    Tokens are made in the JVM and counted inside a row; no n-gram becomes a row, so nothing is shuffled.
    """
    words = lambda c: F.coalesce(text.words(c), F.array().cast("array<string>"))
    joined = lambda c: F.array_join(words(c), " ")
    counted = df.withColumns({
        "_matches": _matches(df.sparkSession, orders)(joined("prediction"), joined("reference")),
        "_p": F.size(words("prediction")), "_r": F.size(words("reference")),
    })
    total = lambda side, order: F.greatest(F.col(side) - order + 1, F.lit(0)).cast("long")
    per_order = [
        F.struct(
            F.lit(order).alias("n"), F.get("_matches", F.lit(at)).alias("matches"),
            total("_p", order).alias("predicted"), total("_r", order).alias("expected"),
        )
        for at, order in enumerate(orders)
    ]
    return counted.withColumn("overlap", F.array(*per_order)).drop("_matches", "_p", "_r")


def _ratio(part, whole):
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _fmeasure(order):
    """F1 of one entry of ``overlap``."""
    return _ratio(2 * order["matches"], order["predicted"] + order["expected"])


def rouge_n(df: DataFrame, key: str, orders: list[int] | None = None) -> DataFrame:
    """(key, n, precision, recall, fmeasure) for every row and order; 0 where a side has no n-gram or no text."""
    found = gram_overlap(df, orders or [1, 2])
    scores = F.transform("overlap", lambda o: F.struct(
        o["n"].alias("n"), _ratio(o["matches"], o["predicted"]).alias("precision"),
        _ratio(o["matches"], o["expected"]).alias("recall"), _fmeasure(o).alias("fmeasure"),
    ))
    return found.select(F.col(key).alias("key"), F.inline_outer(scores))


def _bleu(overlap, smooth: bool):
    """Clipped precision of the orders 1 to 4 of ``overlap`` with brevity penalty."""
    total, possible = F.lit(0.0), F.lit(True)
    for k in range(MAX_ORDER):
        add = 1 if smooth and k else 0
        hit, all_ = overlap[k]["matches"] + add, overlap[k]["predicted"] + add
        possible = possible & (hit > 0) & (all_ > 0)
        total = total + F.log(hit.cast("double") / F.nullif(all_, F.lit(0)))
    predicted, expected = overlap[0]["predicted"], overlap[0]["expected"]
    penalty = F.when(predicted >= expected, 0.0).otherwise(1.0 - expected / F.nullif(predicted, F.lit(0)))
    return F.when(possible, F.exp(total / MAX_ORDER + penalty)).otherwise(F.lit(0.0))


def bleu(df: DataFrame, key: str, smooth: bool = False) -> DataFrame:
    """(key, bleu) of every row: clipped precision of orders 1 to 4 with brevity penalty.

    Without smoothing a pair that misses any order scores 0; ``smooth`` adds one to both counts of
    orders above 1.  A missing text has no words.
    """
    found = gram_overlap(df, list(range(1, MAX_ORDER + 1)))
    return found.select(F.col(key).alias("key"), _bleu(F.col("overlap"), smooth).alias("bleu"))


def exact_match(df: DataFrame, key: str) -> DataFrame:
    """(key, exact_match): 1.0 where the stripped texts are equal."""
    same = text.strip("prediction") == text.strip("reference")
    return df.select(F.col(key).alias("key"), F.coalesce(same, F.lit(False)).cast("double").alias("exact_match"))


def common_subsequence(reference: list[str], candidate: list[str]) -> list[int]:
    """Positions in ``reference`` of one longest common subsequence.

    Bit-parallel: one big integer per candidate word says at which reference positions the length
    grows, so a pair costs words * words / 64 machine steps.  The walk back reads those integers
    from the last candidate word to the first.  Only one in about sqrt(words) of them is kept; those
    between two kept ones are made again when the walk comes to them.
    """
    where: dict[str, int] = {}
    for at, word in enumerate(reference):
        where[word] = where.get(word, 0) | (1 << at)
    full = (1 << len(reference)) - 1

    def grown(flat: int, words: list[str]):
        for word in words:
            hits = flat & where.get(word, 0)
            flat = ((flat + hits) | (flat - hits)) & full
            yield flat

    step = max(1, int(len(candidate) ** 0.5))
    kept = [full]
    for start in range(0, len(candidate), step):
        for last in grown(kept[-1], candidate[start:start + step]):
            pass
        kept.append(last)
    found, i = [], len(reference) - 1
    for block in range(len(kept) - 2, -1, -1):
        start = block * step
        history = list(grown(kept[block], candidate[start:start + step]))
        j = len(history) - 1
        while i >= 0 and j >= 0:
            if reference[i] == candidate[start + j]:
                found.append(i)
                i, j = i - 1, j - 1
            elif not (history[j] >> i) & 1:
                j -= 1
            else:
                i -= 1
    return found[::-1]


def _rouge_l(reference: list[list[str]], candidate: list[list[str]]) -> float:
    """Summary-level F1: union of the common words of each reference sentence with all candidate sentences."""
    n_ref, n_cand = sum(map(len, reference)), sum(map(len, candidate))
    if n_ref == 0 or n_cand == 0:
        return 0.0
    left_ref: dict[str, int] = {}
    left_cand: dict[str, int] = {}
    for counts, sentences in ((left_ref, reference), (left_cand, candidate)):
        for sentence in sentences:
            for word in sentence:
                counts[word] = counts.get(word, 0) + 1
    hits = 0
    for sentence in reference:
        union = sorted({at for other in candidate for at in common_subsequence(sentence, other)})
        for at in union:
            word = sentence[at]
            if left_ref.get(word, 0) > 0 and left_cand.get(word, 0) > 0:
                hits += 1
                left_ref[word] -= 1
                left_cand[word] -= 1
    return 2.0 * hits / (n_cand + n_ref)


def _sentences(column: str, summary: bool):
    lines = F.split(column, "\n") if summary else F.array(F.col(column))
    return F.transform(lines, text.words)


def _longest(df: DataFrame, summary: bool):
    """F1 of the longest common subsequence of ``reference`` and ``prediction``, by lines when ``summary``.

    Tokens are made in the JVM; only the subsequence search runs in Python, batch by batch.
    """
    ship_package(df.sparkSession)

    @F.pandas_udf("double")
    def score(reference: pd.Series, prediction: pd.Series) -> pd.Series:
        def plain(value):
            return [list(s) for s in value if s is not None] if isinstance(value, (list, np.ndarray)) else []

        return pd.Series([_rouge_l(plain(r), plain(p)) for r, p in zip(reference, prediction)], dtype="float64")

    return score(_sentences("reference", summary), _sentences("prediction", summary))


def rouge_l(df: DataFrame, key: str, summary: bool = True) -> DataFrame:
    """(key, rouge_l): longest-common-subsequence F1, by lines when ``summary``; 0 without a text."""
    return df.select(F.col(key).alias("key"), _longest(df, summary).alias("rouge_l"))


def mean_metrics(df: DataFrame, key: str, summary: bool = True) -> DataFrame:
    """(metric, value): means of the overlap scores over all rows.

    The table is read once and nothing is shuffled but sums.
    """
    longest = "rouge_l_sum/mean" if summary else "rouge_l/mean"
    overlap = F.col("overlap")
    same = F.coalesce(text.strip("prediction") == text.strip("reference"), F.lit(False)).cast("double")
    scored = gram_overlap(df.select("prediction", "reference"), list(range(1, MAX_ORDER + 1))).select(
        _bleu(overlap, False).alias("bleu/mean"), _fmeasure(overlap[0]).alias("rouge_1/mean"),
        _fmeasure(overlap[1]).alias("rouge_2/mean"), _longest(df, summary).alias(longest), same.alias("exact_match/mean"),
    )
    means = scored.agg(*[F.avg(f"`{c}`").alias(c) for c in scored.columns])
    return means.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").alias("value")) for c in means.columns])))


def model_gate(current: DataFrame, best: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """One row (compared, deploy): deploy when no gate metric is below the best model's."""
    wanted = metrics or GATE_METRICS
    joined = current.where(F.col("metric").isin(wanted)).select("metric", F.col("value").alias("now")).join(
        best.select("metric", F.col("value").alias("top")), "metric"
    )
    return joined.agg(
        F.count("*").alias("compared"),
        (F.coalesce(F.bool_and(F.col("now") >= F.col("top")), F.lit(False)) & (F.count("*") == len(wanted))).alias("deploy"),
    )


def rubric_prompts(responses: DataFrame, rubrics: list[tuple[str, str]]) -> DataFrame:
    """(.., metric, prompt): every response with every metric's judge prompt."""
    prompts = F.array(*[
        F.struct(F.lit(m).alias("metric"), text.render(t, {"prompt": F.col("prompt"), "response": F.col("response")}).alias("judge_prompt"))
        for m, t in rubrics
    ])
    return responses.select("*", F.inline(prompts))


def rubric_means(judged: DataFrame, reply: str = "reply") -> DataFrame:
    """(metric, mean_score, scored, rejected) from judge replies."""
    score = replies.reply_score(reply)
    return judged.groupBy("metric").agg(
        F.avg(score).alias("mean_score"), F.count(score).alias("scored"), F.count_if(score.isNull()).alias("rejected")
    )
