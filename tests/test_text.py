import random
import re
import string
from html import unescape

import pytest
from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.functions import html, replies, text


def py_clean(value):
    value = value.strip()
    return "".join(c for c in value if c.isalnum() or c.isspace() or c in string.punctuation).lower()


@pytest.mark.parametrize(
    "raw",
    [
        "  Great Course! ", "", "   ", "123 Leading digits", "Curly “quotes” — dash ½", "café naïve",
        " tab\tand nbsp ", "emoji \U0001F600 gone", "一二 ١٢", "\x1csep\x1f",
    ],
)
def test_clean_text(one, raw):
    assert one(text.clean_text("x"), x=raw) == py_clean(raw)


@pytest.mark.parametrize(
    "raw, want",
    [
        ("1 Great course", "Great course"), ("  42  Good ", "Good"), ("", ""), ("   ", ""), ("No number", "No number"),
        ("a\nb\r\tc", "a b  c"),
        ("Positive Neutral Negative\n10 20\nSentiment Score 7 good", "good"),
        ("PERCENT of sentiment x sentiment score\n12 fine", "fine"),
    ],
)
def test_clean_response(one, raw, want):
    assert one(text.clean_response("x"), x=raw) == want


def test_remove_punctuation(one):
    raw = "a" + string.punctuation + "b —"
    assert one(text.remove_punctuation("x"), x=raw) == "ab —"


@pytest.mark.parametrize(
    "raw, flagged, want",
    [
        ("he is kind", True, "the professor is kind"), ("ask him", True, "ask the professor"), ("theme park", False, "theme park"),
        ("He said", True, "He said"), ("a he he b", True, "a the professor he b"), (" spaced ", False, " spaced "),
    ],
)
def test_pronouns(one, raw, flagged, want):
    assert one(text.has_pronoun("x"), x=raw) is flagged
    assert one(text.neutralise_pronouns("x"), x=raw) == want


def py_segments(lines):
    out, current = [], ""
    for line in lines:
        if line.isdigit() and current:
            out.append(current)
            current = ""
        else:
            current += " " + line
    if current.strip():
        out.append(current)
    return out


def test_segmentation_against_plain_loop(spark):
    rng = random.Random(3)
    cases = [[], ["1"], ["1", "2"], ["", "5", "a"], ["a", "1", "2", "b"], ["", ""]]
    cases += [[rng.choice(["1", "22", "a", "b c", ""]) for _ in range(rng.randint(0, 9))] for _ in range(200)]
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "id int, lines array<string>")
    got = {r["id"]: r["s"] for r in frame.select("id", text.segment_responses(F.col("lines")).alias("s")).collect()}
    for i, case in enumerate(cases):
        assert got[i] == py_segments(case), case


def test_semester(one):
    assert one(text.semester_name("x"), x="202530") == "Spring 2025"
    assert one(text.semester_name("x", strict=False), x="202599") is None
    with pytest.raises(Exception, match="unknown term"):
        one(text.semester_name("x"), x="202599")


def test_render_fills_once(one):
    out = text.render("{query} / {content}", {"query": F.col("q"), "content": F.col("c")})
    assert one(out, q="{content}", c="{query}") == "{content} / {query}"
    column = text.render(F.lit("Hi {name}"), {"name": F.col("q")})
    assert one(column, q="you") == "Hi you"


def test_reply_parsing(one):
    two = 'x ```json{"queries": ["a"]}``` y ```json{"queries": ["b"]}```'
    assert one(replies.fenced_json("x", greedy=False), x=two) == '{"queries": ["a"]}'
    assert one(replies.reply_queries("x", greedy=False), x=two) == ["a"]
    assert one(replies.reply_queries("x"), x="no fence") is None
    assert one(replies.reply_queries("x"), x="```json{'queries': ['it', 'is']}```") == ["it", "is"]
    with pytest.raises(Exception, match="no fenced JSON"):
        one(replies.reply_queries("x", strict=True), x="no fence")


@pytest.mark.parametrize("reply, want", [(" 4\n", 4), ("0", None), ("6", None), ("four", None), ("", None)])
def test_reply_score(one, reply, want):
    assert one(replies.reply_score("x"), x=reply) == want


def test_first_tokens_and_tail(one):
    assert one(text.first_tokens("x", 2), x="  a\n b  c") == "a b"
    assert one(text.reply_tail("x"), x="u assistant\nfirst assistant\nlast") == "last"


def test_html_text(one):
    page = "<div><section aria-labelledby='courseDescription'> <b> A &amp; B </b>\n<i>&#233;t&#xe9;</i></section></div>"
    assert one(html.element_text("x", "section", "aria-labelledby", "courseDescription"), x=page) == "A & Bété"
    assert one(html.element_text("x", "section", "aria-labelledby", "courseDescription"), x="<section>no</section>") is None


def test_html_nested_elements(one):
    inner = lambda x: one(html.element_text("x", "section", "class", "a"), x=x)
    assert inner("<section class=a>a<section>b</section>c</section>d") == "abc"
    assert inner("<section><p><section class='a'>in</section></p></section>") == "in"
    assert inner("<SECTION class='a'>open <b>end") == "openend"
    cells = {"first": 0}
    page = "<table class='t'><tbody><tr><td>x<table><tbody><tr><td>y</td></tr></tbody></table></td></tr><tr><td>z</td></tr></tbody></table>"
    assert [r["first"] for r in one(html.table_rows("x", "t", cells), x=page)] == ["xy", "z"]


@pytest.mark.parametrize("raw", [
    "&#38;lt;b", "&eacute;&rsquo;&nbsp;&Eacute;", "&#1114109;", "&#0000039;", "&#x0001F642;", "&#128;", "&#0;", "&#xD800;", "&#99999999999;",
    "&unknown; &amp;amp; & &;", "&fjlig;", "a&lt;b&gt;c", "",
])
def test_entities_like_the_standard(one, raw):
    assert one(html.decode_entities(F.col("x")), x=raw) == unescape(raw)


def test_html_rows(one):
    cells = {"and_or": 0, "subject": 4, "course_number": 5, "level": 6, "grade": 7}
    row = "<tr>" + "".join(f"<td>{c}</td>" for c in ["", "", "", "", "Mathematics", "2321", " Undergraduate ", "C-"]) + "</tr>"
    page = f"<table class='basePreqTable'><thead><tr><th>x</th></tr></thead><tbody>{row}</tbody></table>"
    got = one(html.table_rows("x", "basePreqTable", cells), x=page)
    assert [tuple(r) for r in got] == [("", "Mathematics", "2321", "Undergraduate", "C-")]
    assert one(html.table_rows("x", "basePreqTable", cells), x="<table class='other'></table>") == []
    assert one(html.table_rows("x", "basePreqTable", cells), x=page.replace("<td>C-</td>", "")) == []


def test_constants_are_complete():
    assert C.PUNCTUATION == string.punctuation
    assert set(C.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert len(C.SEED_TEMPLATES) == 15 and len(C.TOPICS) == 28
    assert all(re.search(r"\{prof_name\}", q) for q in C.EVALUATION_TEMPLATES)
