"""Text cleaning and parsing as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrivium import constants as C

_SPACE_CLASS = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_DROPPED = rf"[^\p{{L}}\p{{N}}{_SPACE_CLASS}!-/:-@\[-`{{-~]"
# digit characters: decimal digits plus super- and subscript and circled digits
DIGITS_ONLY = r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨]+$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    """Trim Unicode white space on both ends (``trim`` alone only removes blanks)."""
    return F.btrim(_col(text), F.lit(C.WHITESPACE))


def remove_punctuation(text: Column | str) -> Column:
    """Delete the ASCII punctuation characters."""
    return F.translate(_col(text), C.PUNCTUATION, "")


def clean_text(text: Column | str) -> Column:
    """Strip, keep letters, digits, white space and ASCII punctuation, lower-case."""
    return F.lower(F.regexp_replace(strip(text), _DROPPED, ""))


def flatten_lines(text: Column | str) -> Column:
    """Line breaks and tabs become single blanks."""
    return F.translate(_col(text), "\n\r\t", "   ")


def clean_response(text: Column | str) -> Column:
    """Drop chart captions and a leading index number, then put the text on one line."""
    out = _col(text)
    for pattern in C.CAPTION_PATTERNS:
        out = strip(F.regexp_replace(out, f"(?is){pattern}", ""))
    out = F.regexp_replace(strip(out), rf"^\p{{Nd}}+[{_SPACE_CLASS}]*", "")
    return flatten_lines(out)


def semester_name(term: Column | str, strict: bool = True) -> Column:
    """``202530`` to ``Spring 2025``; an unknown suffix fails, or gives null when not strict."""
    term = _col(term)
    names = F.create_map(*[F.lit(x) for pair in C.SEMESTERS.items() for x in pair])
    pick = F.element_at if strict else F.try_element_at
    name = pick(names, F.right(term, F.lit(2)))
    if strict:
        name = F.when(name.isNull() & term.isNotNull(), F.raise_error(F.concat(F.lit("unknown term "), term))).otherwise(name)
    return F.concat(name, F.lit(" "), F.left(term, F.lit(4)))


def meeting_days(meeting: Column | str) -> Column:
    """Names of the weekdays whose flag is true, Monday first, joined by ';'."""
    meeting = _col(meeting)
    flags = [F.when(meeting.getField(day), F.lit(day)) for day in C.WEEKDAYS]
    return F.concat_ws(";", *flags)


def question_code(text: Column | str) -> Column:
    """Code of a survey question; anything else is 'unknown'."""
    codes = F.create_map(*[F.lit(x) for pair in C.QUESTION_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, _col(text)), F.lit(C.UNKNOWN_QUESTION))


def has_pronoun(text: Column | str) -> Column:
    """True where a listed pronoun stands between blanks, in any case."""
    padded = F.lower(F.concat(F.lit(" "), _col(text), F.lit(" ")))
    found = F.lit(False)
    for word in C.PRONOUNS:
        found = found | F.contains(padded, F.lit(f" {word} "))
    return found


def neutralise_pronouns(text: Column | str) -> Column:
    """Replace listed lower-case pronouns; texts without any pronoun stay untouched."""
    text = _col(text)
    out = F.concat(F.lit(" "), text, F.lit(" "))
    for word in C.PRONOUNS:
        out = F.replace(out, F.lit(f" {word} "), F.lit(f" {C.NEUTRAL_TERM} "))
    return F.when(has_pronoun(text), strip(out)).otherwise(text)


def between(text: Column, marker: str, stop: str) -> Column:
    """Text after the first ``marker`` up to the next ``stop``; '' without a marker."""
    rest = F.split_part(text, F.lit(marker), F.lit(2))
    return F.split_part(rest, F.lit(stop), F.lit(1))


def page_header(page: Column | str) -> Column:
    """Course fields of a page that names a course id, else null."""
    page = _col(page)
    first_line = F.split_part(page, F.lit("\n"), F.lit(1))
    bracket = F.split_part(first_line, F.lit("("), F.lit(2))
    return F.when(
        F.contains(page, F.lit("Course ID")),
        F.struct(
            between(page, "Course ID: ", "\n").alias("crn"),
            between(page, "Catalog & Section: ", " ").alias("course_code"),
            strip(F.split_part(first_line, F.lit("("), F.lit(1))).alias("course_title"),
            between(page, "Instructor: ", "\n").alias("instructor"),
            strip(F.left(bracket, F.greatest(F.length(bracket) - 1, F.lit(0)))).alias("term"),
        ),
    )


def segment_responses(lines: Column) -> Column:
    """Group cleaned lines into responses: a digits-only line closes an open response.

    The line array stays whole, so the order inside a block never depends on a shuffle.
    """
    start = F.struct(
        F.array().cast("array<string>").alias("closed"),
        F.lit("").alias("open"),
    )

    def step(state: Column, line: Column) -> Column:
        closes = line.rlike(DIGITS_ONLY) & (state["open"] != "")
        return F.when(
            closes,
            F.struct(F.concat(state["closed"], F.array(state["open"])).alias("closed"), F.lit("").alias("open")),
        ).otherwise(
            F.struct(state["closed"].alias("closed"), F.concat(state["open"], F.lit(" "), line).alias("open"))
        )

    def finish(state: Column) -> Column:
        tail = F.when(strip(state["open"]) != "", F.array(state["open"])).otherwise(F.array().cast("array<string>"))
        return F.concat(state["closed"], tail)

    return F.aggregate(lines, start, step, finish)


def question_blocks(page: Column | str) -> Column:
    """``array<struct<question, responses>>`` of one page, in page order."""
    page = _col(page)
    parts = F.split(page, re.escape("Q: "))
    blocks = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def parse(block: Column) -> Column:
        lines = F.split(block, "\n")
        rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
        cleaned = F.transform(rest, lambda line: strip(clean_text(line)))
        return F.struct(
            question_code(strip(F.get(lines, F.lit(0)))).alias("question"),
            F.transform(segment_responses(cleaned), clean_response).alias("responses"),
        )

    return F.transform(blocks, parse)


def render(template: Column | str, values: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders in one pass, so braces inside values are never filled again."""
    if isinstance(template, str):
        pieces = re.split(r"(\{[a-z_]+\})", template)
        columns = []
        for piece in pieces:
            name = piece[1:-1] if piece.startswith("{") else None
            if name in values:
                columns.append(values[name])
            elif piece:
                columns.append(F.lit(piece))
        return F.concat(*columns)
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def reply_tail(text: Column | str, marker: str = "assistant\n") -> Column:
    """Text after the last marker."""
    return F.element_at(F.split(_col(text), re.escape(marker)), -1)


def first_tokens(text: Column | str, count: int) -> Column:
    """The first ``count`` white-space tokens joined by blanks."""
    return F.array_join(F.slice(F.split(strip(text), rf"[{_SPACE_CLASS}]+"), 1, count), " ")


def words(text: Column | str) -> Column:
    """Lower-case letter/digit runs (the tokens of the overlap scores)."""
    return F.filter(F.split(F.lower(_col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def text_properties(text: Column | str) -> dict[str, Column]:
    """Numeric properties whose distributions are compared between two corpora."""
    text = _col(text)
    tokens = F.filter(F.split(text, r"[ \t\n\r]+"), lambda w: w != "")
    sizes = F.transform(tokens, lambda w: F.length(w))
    chars = F.length(text)
    total = F.aggregate(sizes, F.lit(0), lambda a, x: a + x)
    punctuation = chars - F.length(remove_punctuation(text))
    special = F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s!-/:-@\[-`{-~]", ""))

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))

    return {
        "text_length": chars.cast("double"),
        "mean_word_length": share(total, F.size(tokens)),
        "max_word_length": F.coalesce(F.array_max(sizes), F.lit(0)).cast("double"),
        "punctuation_share": share(punctuation, chars),
        "special_share": share(special, chars),
    }
