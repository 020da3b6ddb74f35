"""Extraction from HTML text with JVM regular expressions."""

from __future__ import annotations

from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrivium.functions.text import _col, strip

#: A character reference; the names are those of the HTML standard, from Python's table.
_REFERENCE = "&(#[xX][0-9a-fA-F]+|#[0-9]+|[A-Za-z][A-Za-z0-9]*);"
_NAMES = "\x02".join(f"{name[:-1]}\x01{value}" for name, value in sorted(entities.html5.items()) if name.endswith(";"))
_REPLACEMENT = "\ufffd"
#: What browsers show for 128 to 159: the bytes of the Western code page, where it has them.
_WESTERN = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160))


def _numeric(body: Column) -> Column:
    """Character of a reference body such as ``#233`` or ``#xE9``, by the HTML rules for odd numbers."""
    is_hex = F.lower(F.substring(body, 2, 1)) == "x"
    digits = F.regexp_replace(body, "^#[xX]?0*", "")
    long = F.length(digits) > 8
    code = F.when(long, F.lit(0)).otherwise(
        F.coalesce(F.conv(F.when(is_hex, digits), 16, 10), F.conv(F.when(~is_hex, digits), 10, 10)).try_cast("bigint"))
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    western = F.substring(F.lit(_WESTERN), code.cast("int") - 127, F.lit(1))
    bad = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    return F.when(bad, F.lit(_REPLACEMENT)).when(code.between(128, 159), western).otherwise(plain)


def _character(body: Column) -> Column:
    """What a reference body such as ``#233`` or ``eacute`` stands for, null for an unknown name.

    The usual names are tried one by one; only the others look through the whole table.
    """
    char = F.when(body.startswith("#"), _numeric(body))
    for name in ("amp", "lt", "gt", "quot", "apos", "nbsp"):
        char = char.when(body == name, F.lit(entities.html5[f"{name};"]))
    return char.otherwise(F.try_element_at(F.str_to_map(F.lit(_NAMES), F.lit("\x02"), F.lit("\x01")), body))


def decode_entities(text: Column) -> Column:
    """Numeric and named character references of any length, each decoded once; unknown names stay.

    A text's distinct references are decoded first, so one that repeats costs a look into a small map.
    """
    bodies = F.array_distinct(F.regexp_extract_all(text, F.lit(_REFERENCE), 1))
    known = F.map_from_arrays(bodies, F.transform(bodies, _character))

    def decoded(chunk: Column, known: Column) -> Column:
        body = F.regexp_extract(chunk, f"^{_REFERENCE}", 1)
        char = F.try_element_at(known, body)
        return F.when((body == "") | char.isNull(), chunk).otherwise(F.concat(char, chunk.substr(F.length(body) + 3, F.length(chunk))))

    # a lambda's variable holds its value; a column inside a lambda would be made again for every chunk
    once = F.array(F.struct(known.alias("known"), F.split(text, f"(?={_REFERENCE})").alias("chunks")))
    joined = F.transform(once, lambda x: F.array_join(F.transform(x["chunks"], lambda chunk: decoded(chunk, x["known"])), ""))
    return F.when(text.rlike(_REFERENCE), F.get(joined, F.lit(0))).otherwise(text)


def without_comments(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<!--.*?-->", "")


def _joined(fragment: Column) -> Column:
    return F.array_join(F.transform(F.split(fragment, r"<[^>]*>"), lambda t: strip(decode_entities(t))), "")


def _plain(fragment: Column) -> Column:
    return strip(decode_entities(F.regexp_replace(fragment, r"<[^>]*>", "")))


def joined_text(fragment: Column) -> Column:
    """Text pieces of a fragment, each stripped, joined without a separator."""
    return _joined(without_comments(fragment))


def plain_text(fragment: Column) -> Column:
    """Text of a fragment with tags removed and the ends stripped."""
    return _plain(without_comments(fragment))


def elements(html: Column, tag: str, attributes: str = "") -> Column:
    """Inner HTML of the outermost elements of a name; elements of the same name inside are part of it.

    ``attributes`` is a lookahead that the opening tag must meet.  An element without an end tag
    reaches to the end.
    """
    opening = rf"(?is)^<{tag}\b{attributes}[^>]*>"
    chunks = F.split(html, rf"(?i)(?=</?{tag}\b)")
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"), F.array().cast("array<string>").alias("out"))

    def step(at: Column, chunk: Column) -> Column:
        depth, text, out = at["depth"], at["text"], at["out"]
        starts = (depth == 0) & chunk.rlike(opening)
        opens, closes = chunk.rlike(rf"(?i)^<{tag}\b"), chunk.rlike(rf"(?i)^</{tag}\b")
        ends = (depth == 1) & closes
        return F.struct(
            F.when(starts, 1).when((depth > 0) & opens, depth + 1).when((depth > 0) & closes, depth - 1).otherwise(depth).alias("depth"),
            F.when(starts, F.regexp_replace(chunk, opening, "")).when(ends | (depth == 0), "").otherwise(F.concat(text, chunk)).alias("text"),
            F.when(ends, F.concat(out, F.array(text))).otherwise(out).alias("out"),
        )

    def finish(at: Column) -> Column:
        return F.when(at["depth"] > 0, F.concat(at["out"], F.array(at["text"]))).otherwise(at["out"])

    return F.aggregate(chunks, start, step, finish)


def element_text(html: Column | str, tag: str, attribute: str | None = None, value: str | None = None) -> Column:
    """Joined text of the first matching element, null if there is none."""
    attrs = "" if attribute is None else rf"""(?=[^>]*\b{attribute}\s*=\s*["']?{value}["']?[\s>/])"""
    return _joined(F.get(elements(without_comments(_col(html)), tag, attrs), F.lit(0)))


def table_rows(html: Column | str, css_class: str, cells: dict[str, int]) -> Column:
    """Body rows of the first table with a class, as ``array<struct>`` of the named cells.

    A row with too few cells empties the whole list: the table is then not in the known layout.
    """
    wanted = rf"""(?=[^>]*\bclass\s*=\s*["'][^"']*\b{css_class}\b[^"']*["'])"""
    table = F.get(elements(without_comments(_col(html)), "table", wanted), F.lit(0))
    rows = elements(F.get(elements(table, "tbody"), F.lit(0)), "tr")
    parts = F.transform(rows, lambda r: elements(r, "td"))
    empty = F.array().cast("array<struct<" + ",".join(f"{n}:string" for n in cells) + ">>")

    def filled(parts: Column) -> Column:
        result = F.transform(
            parts,
            lambda c: F.struct(*[_plain(F.get(c, F.lit(i))).alias(name) for name, i in cells.items()]),
        )
        short = F.exists(parts, lambda c: F.size(c) <= max(cells.values()))
        return F.when(parts.isNull() | short, empty).otherwise(result)

    # a lambda's variable holds its value, so the table is taken apart once
    return F.get(F.transform(F.array(parts), filled), F.lit(0))
