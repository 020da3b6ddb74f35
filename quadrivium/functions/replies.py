"""Parsing of model replies that arrive as text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrivium.functions.text import _col, strip


def fenced_json(reply: Column | str, greedy: bool = True, strict: bool = False) -> Column:
    """Body of a ```json fence; null (or an error when strict) without a fence."""
    reply = _col(reply)
    pattern = r"(?s)```json(.*)```" if greedy else r"(?s)```json(.*?)```"
    body = F.get(F.regexp_extract_all(reply, F.lit(pattern), 1), F.lit(0))
    if strict:
        return F.when(body.isNull(), F.raise_error(F.lit("no fenced JSON in reply"))).otherwise(body)
    return body


def reply_queries(reply: Column | str, greedy: bool = True, strict: bool = False) -> Column:
    """The ``queries`` list of a fenced reply; single-quoted literals are accepted as well."""
    parsed = F.from_json(
        fenced_json(reply, greedy, strict), "queries array<string>", {"allowSingleQuotes": "true"}
    )
    return parsed["queries"]


def reply_score(reply: Column | str, low: int = 1, high: int = 5) -> Column:
    """Integer score of a reply, null where it is no integer in range."""
    score = F.expr("int(null)") if reply is None else strip(_col(reply)).try_cast("int")
    return F.when(score.between(low, high), score)
