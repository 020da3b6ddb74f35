"""Secret scans with multipart credential linking, in DataFrame operations only.

Every kind of part has a pattern.  Its matches and the gaps between them (``regexp_extract_all`` and ``split``) give the
place of each match as a running sum of lengths, linear in the text.  Base kinds stand for themselves.  Weak kinds, an
account name, a key-like word, an endpoint, are reported only when the parts they need lie within ``SCOPE`` characters:
parts are dealt to all scopes (document, place // SCOPE) that they touch and joined as intervals, weak parts to all that
their span and ``SCOPE`` characters on either side touch, by semi joins that make no pairs.

A weak key needs an access identifier or an account; a weak account needs a secret; an endpoint needs both.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrivium.llm.common import whole_row, whole_text
from quadrivium.session import cut_lineage

SCOPE = 200
#: kind -> (pattern, group whose length counts, least length); fixed values of the contract come first.
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
WEAK = {
    "account": (r"""((?i:username|user|login|account|client_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]+)""", 2, 3),
    "key": (r"[A-Za-z0-9+/_-]{32,}", 0, 32),
    "endpoint": (r"(?:https?|ftp|ssh|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]+", 0, 10),
}
KINDS = [*BASE, *WEAK]
SECRETS, IDENTIFIERS = ["assign", "hex", "key"], ["access", "account"]


def _matches(text: Column, number: int, pattern: str, group: int, least: int) -> Column:
    """Array of (kind, idx, gap, size, good) of the matches of one kind, empty where there is none."""
    p = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    sizes = F.transform(F.regexp_extract_all(text, p, F.lit(0)), lambda m: F.length(m))
    values = F.regexp_extract_all(text, p, F.lit(group))
    good = F.transform(values, lambda v: F.length(v) >= least)
    if KINDS[number] == "key":
        good = F.transform(values, lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]"))
    rows = F.transform(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(sizes)).alias("gap"), sizes.alias("size"), good.alias("good")),
                       lambda m, k: F.struct(F.lit(number).alias("kind"), k.alias("idx"), m["gap"].alias("gap"),
                                             m["size"].alias("size"), m["good"].alias("good")))
    none = F.array().cast("array<struct<kind:int,idx:int,gap:int,size:int,good:boolean>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def _parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every good match: ``_id, _hash, kind`` (its number), ``start, end``, in code points, end exclusive."""
    text = F.col("_text")
    found = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    arrays = [_matches(text, k, *rule) for k, rule in enumerate([*BASE.values(), *WEAK.values()])]
    rows = found.select("_id", F.xxhash64("_text").alias("_hash"), F.explode(F.concat(*arrays)).alias("m")).select("_id", "_hash", "m.*")
    rows = rows.distinct()  # rows that repeat an id and a text count once here
    within = Window.partitionBy("_id", "_hash", "kind").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(within)
    return rows.withColumn("end", end).filter("good").select("_id", "_hash", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def _numbers(kinds: list[str]) -> list[int]:
    return [KINDS.index(k) for k in kinds]


def _scopes(first: Column, last: Column, scope: int) -> Column:
    """One row for each scope from that of the place ``first`` to that of ``last``."""
    return F.explode(F.sequence(F.floor(first / scope), F.floor(last / scope)))


def _near(weak: DataFrame, parts: DataFrame, kinds: list[str], scope: int) -> DataFrame:
    """The rows of ``weak`` that have a part of ``kinds`` within ``scope`` characters."""
    left = weak.withColumn("_scope", _scopes(F.col("start") - scope, F.col("end") + scope, scope))
    right = parts.filter(F.col("kind").isin(_numbers(kinds))).select(
        F.col("_id").alias("r_id"), F.col("_hash").alias("r_hash"), _scopes(F.col("start"), F.col("end"), scope).alias("r_scope"),
        F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    same = left["_id"].eqNullSafe(right["r_id"]) & (left["_hash"] == right["r_hash"]) & (left["_scope"] == right["r_scope"])
    close = (F.col("r_start") - F.col("end") <= scope) & (F.col("start") - F.col("r_end") <= scope)
    return left.join(right, same & close, "left_semi").drop("_scope").distinct()


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """Base parts, and the weak ones that their complements confirm and no base part covers."""
    base = parts.filter(F.col("kind").isin(_numbers(list(BASE))))
    weak = parts.filter(F.col("kind").isin(_numbers(list(WEAK))))
    cover = base.select(F.col("_id").alias("r_id"), F.col("_hash").alias("r_hash"), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    free = weak.join(cover, weak["_id"].eqNullSafe(cover["r_id"]) & (F.col("_hash") == F.col("r_hash"))
                     & (F.col("start") < F.col("r_end")) & (F.col("r_start") < F.col("end")), "left_anti")
    free = cut_lineage(free)
    usable = base.unionByName(free)
    rules = [("key", [IDENTIFIERS]), ("account", [SECRETS]), ("endpoint", [IDENTIFIERS, SECRETS])]
    confirmed = [
        reduce(lambda rows, kinds: _near(rows, usable, kinds, scope), needs, free.filter(F.col("kind") == KINDS.index(kind)))
        for kind, needs in rules
    ]
    return reduce(DataFrame.unionByName, [base, *confirmed])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per span: id, ``_hash`` (of the text), ``kind`` (number in ``KINDS``), ``start, end``.

    Null texts are empty and have no spans; a null id is carried as null; rows that repeat an id and a text share one
    set of spans.  Other columns are ignored, whatever their names.
    """
    return _linked(cut_lineage(_parts(docs, id_col, text_col)), scope).withColumnRenamed("_id", id_col)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def _is(number: int) -> Callable[[Column], Column]:
    return lambda kind: kind == number


def secret_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: id, ``n_assign, n_access, n_hex, base_sha256, spans``; no spans give the empty text.

    A null text is empty; rows that repeat an id and a text are all returned, with the same spans.  An empty table gives
    an empty result.  Other columns are ignored, whatever their names.
    """
    spans = find_secrets(docs, id_col, text_col, scope)
    own = spans.groupBy(F.col(id_col).alias("_span_id"), F.col("_hash").alias("_span_hash")).agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("_all"))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(whole_text(text_col)).alias("_hash"))
    joined = rows.join(own, F.col("_id").eqNullSafe(F.col("_span_id")) & (F.col("_hash") == F.col("_span_hash")), "left")
    everything = F.coalesce("_all", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    joined = joined.select("_id", everything.alias("_all")).withColumn("_base", F.filter("_all", lambda s: s["kind"] < len(BASE)))
    kinds = F.transform("_base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _is(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(BASE)]
    return joined.select(F.col("_id").alias(id_col), *counts, F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
                         _joined(F.col("_all")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with each run of overlapping spans in the text replaced by ``mask``; all columns and rows stay.

    A null text stays null and an empty one empty; a null id is an id like any other, and rows that repeat an id and a
    text are masked alike.  An empty table gives an empty result.  Columns may have any names.
    """
    spans = find_secrets(docs, id_col, text_col, scope).select(F.col(id_col).alias("id"), "_hash", "start", "end")
    order = Window.partitionBy("id", "_hash").orderBy("start", "end")  # the spans of one text
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1))
    runs = opened.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy("id", "_hash", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    own = runs.groupBy(F.col("id").alias("span_id"), F.col("_hash").alias("span_hash")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))
    keyed = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("row_id"), F.col(text_col).alias("row_text"),
                        F.xxhash64(whole_text(text_col)).alias("row_hash"))
    joined = keyed.join(own, F.col("row_id").eqNullSafe(F.col("span_id")) & (F.col("row_hash") == F.col("span_hash")), "left")
    text, last = F.col("row_text"), lambda k: F.when(k == 0, 0).otherwise(F.element_at("runs", F.greatest(k, F.lit(1)))["end"])
    before = F.transform("runs", lambda r, k: F.concat(
        F.substring(text, last(k).cast("int") + 1, (r["start"] - last(k)).cast("int")), F.lit(mask)))
    rest = F.substring(text, F.element_at("runs", -1)["end"].cast("int") + 1, F.length(text))
    clean = F.when(F.col("runs").isNull(), text).otherwise(F.concat(F.concat_ws("", before), rest))
    return joined.select(*[clean.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
