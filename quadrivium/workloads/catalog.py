"""Catalog payloads built from the driver tables, read back by the catalog plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.functions import html, text
from quadrivium.plans import catalog
from quadrivium.workloads import tables as t


def _catalog_payloads(spark, sf):
    entry = F.struct(
        F.col("p_partkey").cast("string").alias("courseReferenceNumber"),
        F.col("p_type").alias("campusDescription"),
        F.col("p_name").alias("courseTitle"),
        F.concat(F.lit("CS"), F.col("p_size").cast("string")).alias("subjectCourse"),
    )
    return t.read(spark, sf, "part").select(F.to_json(F.struct(F.lit(1).alias("totalCount"), F.array(entry).alias("data"))).alias("json"))


def _catalog(spark, sf):
    return catalog.flatten_catalog(_catalog_payloads(spark, sf), "202530")


def catalog_flatten(spark, sf):
    return _catalog(spark, sf)


def _meeting(key, days=4):
    """Flags of the first days only; a payload may leave out the rest."""
    flags = [(F.pmod(key + i, F.lit(3)) == 0).alias(day) for i, day in enumerate(C.WEEKDAYS[:days])]
    return F.struct(F.lpad(F.pmod(key, F.lit(24)).cast("string"), 4, "0").alias("beginTime"), *flags)


def _faculty_payloads(spark, sf):
    # one payload per supplier; suppliers in debt list no faculty
    names = F.when(F.col("s_acctbal") >= 0, F.array(F.struct(F.col("s_name").alias("displayName")))).otherwise(
        F.array().cast("array<struct<displayName:string>>")
    )
    fmt = F.array(F.struct(names.alias("faculty"), _meeting(F.col("s_suppkey")).alias("meetingTime")))
    return t.read(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("crn"), F.to_json(F.struct(fmt.alias("fmt"))).alias("json")
    )


def faculty_payload(spark, sf):
    return catalog.faculty_info(_faculty_payloads(spark, sf))


def meeting_days(spark, sf):
    key = F.col("o_orderkey")
    return t.read(spark, sf, "orders").select("o_orderkey", text.meeting_days(_meeting(key, 7)).alias("days"))


def _escape(column):
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("é", "&#0000233;"), ("è", "&egrave;"), ("ü", "&#xFC;")):
        column = F.replace(column, F.lit(char), F.lit(name))
    return column


def _description_payloads(spark, sf):
    page = F.concat(
        F.lit('<html><body><!-- x --><section class="a" aria-labelledby="courseDescription">\n'), _escape(F.col("text")),
        F.lit("<section><section class='b'> inner</section></section> &#38;lt;end\n</section><section>other</section></body></html>"),
    )
    return t.read(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("crn"), F.when(F.col("doc_id") % 9 == 4, F.lit("<p>none</p>")).otherwise(page).alias("html")
    )


def course_descriptions(spark, sf):
    return catalog.descriptions(_description_payloads(spark, sf))


def _prereq_payloads(spark, sf):
    cells = [F.col("p_brand"), F.lit("x"), F.lit("y"), F.lit("z"), F.col("p_name"), F.col("p_size").cast("string"), F.col("p_type"), F.lit(" C- ")]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td> "), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    table = F.concat(
        F.lit('<table class="basePreqTable"><thead><tr><th>h</th></tr></thead><tbody>'), row, row, F.lit("</tbody></table>")
    )
    return t.read(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("crn"), F.when(F.col("p_size") > 25, table).otherwise(F.lit("<div></div>")).alias("html")
    )


def prerequisite_rows(spark, sf):
    rows = catalog.prerequisites(_prereq_payloads(spark, sf))
    return rows.select("crn", F.posexplode_outer("prereq").alias("pos", "p")).select("crn", "pos", "p.*")


def _enriched(spark, sf):
    return catalog.enrich(
        _catalog(spark, sf),
        catalog.faculty_info(_faculty_payloads(spark, sf)),
        catalog.descriptions(_description_payloads(spark, sf)),
        catalog.prerequisites(_prereq_payloads(spark, sf)),
    )


def enrichment_left_join(spark, sf):
    return _enriched(spark, sf).withColumn("prereq", F.size("prereq"))


def missing_faculty_report(spark, sf):
    return catalog.publishable(_enriched(spark, sf))[1]


def publishable_catalog(spark, sf):
    return catalog.publishable(_enriched(spark, sf))[0].select("crn", "faculty_name", "days", "term", F.length("course_description").alias("chars"))


def html_title(spark, sf):
    return t.read(spark, sf, "pages").select("page_id", html.element_text("html", "title").alias("title"))


def json_props(spark, sf):
    rows = t.read(spark, sf, "events").select("event_type", F.from_json("props", "k INT")["k"].alias("k"))
    return rows.groupBy("event_type").agg(F.sum("k").alias("total"), F.count("k").alias("n"))


QUERIES = {
    f.__name__: f
    for f in [
        catalog_flatten, faculty_payload, meeting_days, course_descriptions, prerequisite_rows, enrichment_left_join,
        missing_faculty_report, publishable_catalog, html_title, json_props,
    ]
}

def _days(key: str, days: int = 4) -> str:
    flags = ", ".join(f"CASE WHEN ({key} + {i}) % 3 = 0 THEN '{d}' END" for i, d in enumerate(C.WEEKDAYS[:days]))
    return f"concat_ws(';', {flags})"


_PARTS = """parts AS (
  SELECT CAST(p_partkey AS VARCHAR) AS crn, p_type AS campus_description, p_name AS course_title, 'CS' || p_size AS subject_course,
         'Spring 2025' AS term, p_size, p_brand, p_type FROM part)"""
_FACULTY = f"""faculty AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS crn, CASE WHEN s_acctbal >= 0 THEN s_name ELSE '' END AS faculty_name,
         lpad(CAST(s_suppkey % 24 AS VARCHAR), 4, '0') AS begin_time, '' AS end_time, {_days('s_suppkey')} AS days FROM supplier)"""
# every piece of text between tags is stripped before the pieces are joined
_DESCRIPTION = f"({t.sql_strip('text')} || 'inner' || '&lt;end')"
_DESCRIBED = f"""described AS (
  SELECT CAST(doc_id AS VARCHAR) AS crn,
         CASE WHEN doc_id % 9 = 4 THEN '{catalog.NO_DESCRIPTION}' ELSE {t.sql_response(_DESCRIPTION)} END AS course_description
  FROM documents)"""
_ENRICHED = t.with_(_PARTS, _FACULTY, _DESCRIBED) + """, enriched AS (
  SELECT p.crn, p.campus_description, p.course_title, p.subject_course, coalesce(f.faculty_name, '') AS faculty_name,
         coalesce(d.course_description, '') AS course_description, p.term, coalesce(f.begin_time, '') AS begin_time,
         coalesce(f.end_time, '') AS end_time, coalesce(f.days, '') AS days,
         CAST(CASE WHEN p.p_size > 25 THEN 2 ELSE 0 END AS INT) AS prereq
  FROM parts p LEFT JOIN faculty f ON p.crn = f.crn LEFT JOIN described d ON p.crn = d.crn) """

_ENTITY = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
for _name, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    _ENTITY = f"replace({_ENTITY}, '{_name}', '{_char}')"

SQL = {
    "catalog_flatten": t.with_(_PARTS) + """SELECT crn, campus_description, course_title, subject_course, '' AS faculty_name,
        '' AS course_description, term, '' AS begin_time, '' AS end_time, '' AS days, '' AS prereq FROM parts""",
    "faculty_payload": t.with_(_FACULTY) + "SELECT * FROM faculty",
    "meeting_days": f"SELECT o_orderkey, {_days('o_orderkey', 7)} AS days FROM orders",
    "course_descriptions": t.with_(_DESCRIBED) + "SELECT * FROM described",
    "prerequisite_rows": t.with_(_PARTS) + """
        SELECT crn, CAST(i AS INT) AS pos, p_brand AS and_or, course_title AS subject, CAST(p_size AS VARCHAR) AS course_number,
               p_type AS level, 'C-' AS grade FROM parts, range(2) r(i) WHERE p_size > 25
        UNION ALL SELECT crn, NULL, NULL, NULL, NULL, NULL, NULL FROM parts WHERE p_size <= 25""",
    "enrichment_left_join": _ENRICHED + "SELECT * FROM enriched",
    "missing_faculty_report": _ENRICHED + """
        SELECT crn, 'CRN: ' || crn || ', Course: ' || subject_course || ', Term: ' || term AS report_line
        FROM enriched WHERE faculty_name = ''""",
    "publishable_catalog": _ENRICHED
    + "SELECT crn, faculty_name, days, term, CAST(length(course_description) AS INT) AS chars FROM enriched WHERE faculty_name <> ''",
    "html_title": f"SELECT page_id, {t.sql_strip(_ENTITY)} AS title FROM pages",
    "json_props": """SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS INT)) AS BIGINT) AS total, count(*) AS n
        FROM events GROUP BY event_type""",
}
