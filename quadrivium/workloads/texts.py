"""Scalar text functions over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.functions import replies, text
from quadrivium.plans import training
from quadrivium.workloads import tables as t


def clean_text(spark, sf):
    return t.read(spark, sf, "documents").select("doc_id", text.clean_text("text").alias("cleaned"))


def clean_response(spark, sf):
    # a caption around the speaker, an index number, then the turn
    raw = F.concat(
        F.lit("12 Percent of Sentiment:\n"), "role", F.lit("\nSentiment Score "), (F.col("turn") + 1).cast("string"),
        F.lit("\t"), "text",
    )
    return t.read(spark, sf, "conversations").select("conv_id", "turn", text.clean_response(raw).alias("cleaned"))


def remove_punctuation(spark, sf):
    return t.read(spark, sf, "documents").select("doc_id", text.remove_punctuation("text").alias("plain"))


def flatten_lines(spark, sf):
    return t.read(spark, sf, "documents").select("doc_id", text.flatten_lines("text").alias("flat"))


def pronoun_neutralise(spark, sf):
    cleaned = text.clean_text("text")
    return t.read(spark, sf, "documents").select(
        "doc_id", text.has_pronoun(cleaned).alias("flagged"), text.neutralise_pronouns(cleaned).alias("neutral")
    )


def text_properties(spark, sf):
    return t.read(spark, sf, "documents").select(
        "doc_id", *[F.round(c, 9).alias(n) for n, c in text.text_properties("text").items()]
    )


def first_tokens(spark, sf):
    return t.read(spark, sf, "documents").select("doc_id", text.first_tokens("text", 40).alias("head"))


def reply_tail(spark, sf):
    raw = F.concat(F.lit("system\nassistant\n"), "query", F.lit("\nassistant\n"), F.coalesce("response", F.lit("")))
    return t.dialogue(spark, sf).select("id", text.reply_tail(raw).alias("tail"))


def semester_name(spark, sf):
    # order dates as term codes: one of the five suffixes by month
    code = F.element_at(F.array(*[F.lit(c) for c in C.SEMESTERS]), F.month("o_orderdate") % 5 + 1)
    return t.read(spark, sf, "orders").select(
        "o_orderkey", text.semester_name(F.concat(F.date_format("o_orderdate", "yyyy"), code)).alias("semester")
    )


def time_stamps(spark, sf):
    return t.read(spark, sf, "events").select(
        "event_id", F.unix_timestamp("ts").alias("epoch"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp")
    )


def reply_queries(spark, sf):
    body = F.to_json(F.struct(F.array("query", "response").alias("queries")))
    reply = F.concat(F.lit("Sure:\n```json"), body, F.lit("```"))
    rows = t.dialogue(spark, sf).select("id", replies.reply_queries(reply).alias("qs"))
    return rows.select("id", F.posexplode("qs").alias("pos", "new_query"))


def reply_queries_first_fence(spark, sf):
    def fence(name):
        return F.concat(F.lit("```json"), F.to_json(F.struct(F.array(name).alias("queries"))), F.lit("```\n"))

    reply = F.concat(fence("query"), fence("response"))
    rows = t.dialogue(spark, sf).select("id", replies.reply_queries(reply, greedy=False, strict=True).alias("qs"))
    return rows.select("id", F.explode("qs").alias("new_query"))


def reply_scores(spark, sf):
    raw = F.concat(F.lit(" "), F.when(F.col("toxic") == 1, F.lit("score 9")).otherwise((F.col("quality") * 7 - 1 + F.col("doc_id") % 3).cast("string")), F.lit("\n"))
    return t.read(spark, sf, "labels").select("doc_id", replies.reply_score(raw).alias("score"))


def render_prompt(spark, sf):
    prompt = text.render(t.PROMPT, {"query": F.col("query"), "content": F.col("response")})
    return t.dialogue(spark, sf).select("id", prompt.alias("prompt"))


def chat_messages(spark, sf):
    rows = training.chat_messages(t.dialogue(spark, sf).withColumn("context", F.col("response")), max_tokens=25, template=t.PROMPT)
    return rows.select("id", F.posexplode("messages").alias("pos", "m")).select("id", "pos", "m.role", "m.content")


def chat_messages_whole(spark, sf):
    """The same messages with the whole context."""
    rows = training.chat_messages(t.dialogue(spark, sf).withColumn("context", F.col("response")), template=t.PROMPT)
    return rows.select("id", F.posexplode("messages").alias("pos", "m")).select("id", "pos", "m.role", "m.content")


QUERIES = {
    f.__name__: f
    for f in [
        clean_text, clean_response, remove_punctuation, flatten_lines, pronoun_neutralise, text_properties, first_tokens,
        reply_tail, semester_name, time_stamps, reply_queries, reply_queries_first_fence, reply_scores, render_prompt,
        chat_messages, chat_messages_whole,
    ]
}

_cleaned = t.sql_clean("text")
_neutral = f"' ' || {_cleaned} || ' '"
for _word in C.PRONOUNS:
    _neutral = f"replace({_neutral}, ' {_word} ', ' {C.NEUTRAL_TERM} ')"
_flag = " OR ".join(f"contains(' ' || lower({_cleaned}) || ' ', ' {w} ')" for w in C.PRONOUNS)
_head, _rest = t.PROMPT.replace("'", "''").split("{query}")
_middle, _tail = _rest.split("{content}")
_tokens = "list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda w: w <> '')"
_names = list(C.SEMESTERS.values())
_special = "length(regexp_replace(text, '[\\p{L}\\p{N}\\s\\x0b!-/:-@\\[-`{-~]', '', 'g'))"


def _tokens_head(x: str, n: int) -> str:
    return f"array_to_string(list_slice(string_split_regex({t.sql_strip(x)}, '[{t._CLASS}]+'), 1, {n}), ' ')"


def _messages_sql(content: str) -> str:
    return t.with_(t.DIALOGUE) + f"""SELECT id, CAST(0 AS INT) AS pos, 'system' AS role, '{C.SYSTEM_INSTRUCTION}' AS content FROM dialogue
        UNION ALL SELECT id, 1, 'user', '{_head}' || query || '{_middle}' || {content} || '{_tail}' FROM dialogue"""


SQL = {
    "clean_text": f"SELECT doc_id, {_cleaned} AS cleaned FROM documents",
    # the caption runs up to the first 'sentiment score', so index, role and score words vanish
    "clean_response": f"""
        WITH raw AS (SELECT conv_id, turn, '12 Percent of Sentiment:' || chr(10) || role || chr(10) || 'Sentiment Score '
                     || (turn + 1) || chr(9) || text AS r FROM conversations)
        SELECT conv_id, turn, {t.sql_response('r')} AS cleaned FROM raw""",
    "remove_punctuation": f"SELECT doc_id, {t.sql_plain('text')} AS plain FROM documents",
    "flatten_lines": f"SELECT doc_id, {t.sql_flat('text')} AS flat FROM documents",
    "pronoun_neutralise": f"""
        SELECT doc_id, ({_flag}) AS flagged,
               CASE WHEN {_flag} THEN {t.sql_strip(_neutral)} ELSE {_cleaned} END AS neutral FROM documents""",
    "text_properties": f"""
        WITH p AS (SELECT doc_id, text, length(text) AS n, {_tokens} AS w FROM documents)
        SELECT doc_id, CAST(n AS DOUBLE) AS text_length,
               round(CASE WHEN len(w) > 0 THEN list_sum(list_transform(w, lambda x: length(x))) / CAST(len(w) AS DOUBLE) ELSE 0 END, 9) AS mean_word_length,
               CAST(coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS DOUBLE) AS max_word_length,
               round(CASE WHEN n > 0 THEN (n - length({t.sql_plain('text')})) / CAST(n AS DOUBLE) ELSE 0 END, 9) AS punctuation_share,
               round(CASE WHEN n > 0 THEN {_special} / CAST(n AS DOUBLE) ELSE 0 END, 9) AS special_share
        FROM p""",
    "first_tokens": f"SELECT doc_id, {_tokens_head('text', 40)} AS head FROM documents",
    "reply_tail": t.with_(t.DIALOGUE) + "SELECT id, coalesce(response, '') AS tail FROM dialogue",
    "semester_name": f"""
        SELECT o_orderkey, list_extract({_names!r}, CAST(month(o_orderdate) % 5 + 1 AS INT)) || ' ' || year(o_orderdate) AS semester
        FROM orders""",
    "time_stamps": """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events""",
    "reply_queries": t.with_(t.DIALOGUE)
    + "SELECT id, CAST(0 AS INT) AS pos, query AS new_query FROM dialogue UNION ALL SELECT id, 1, response FROM dialogue",
    "reply_queries_first_fence": t.with_(t.DIALOGUE) + "SELECT id, query AS new_query FROM dialogue",
    "reply_scores": """
        WITH s AS (SELECT doc_id, toxic, CAST(quality * 7 - 1 + doc_id % 3 AS INT) AS v FROM labels)
        SELECT doc_id, CASE WHEN toxic = 0 AND v BETWEEN 1 AND 5 THEN v END AS score FROM s""",
    "render_prompt": t.with_(t.DIALOGUE)
    + f"SELECT id, '{_head}' || query || '{_middle}' || response || '{_tail}' AS prompt FROM dialogue",
    "chat_messages": _messages_sql(_tokens_head("coalesce(response, '')", 25)),
    "chat_messages_whole": _messages_sql("coalesce(response, '')"),
}
