"""HTML descriptions: plain text and attribute tables."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from canteiro.functions.text import _col, once

_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<![a-z][^>]*>"
_TAG = r"(?s)</?[a-zA-Z][^>]*>"
_CUT = "\u0001"


def _entity_char(name: Column) -> Column:
    """Character of one entity name or numeric reference, of any plane."""
    names = ";".join(f"{key}:{chr(code)}" for key, code in name2codepoint.items())
    table = F.str_to_map(F.lit(names), F.lit(";"), F.lit(":"))  # constant, folded by the optimizer
    code = F.when(
        name.rlike(r"^#[xX]0*[0-9a-fA-F]{1,6}$"), F.conv(F.regexp_extract(name, "([0-9a-fA-F]{1,6})$", 1), 16, 10).try_cast("int")
    ).when(name.rlike(r"^#0*\d{1,7}$"), F.regexp_extract(name, r"(\d{1,7})$", 1).try_cast("int"))
    known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    by_code = F.when(known, F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0")), "UTF-32"))
    return F.coalesce(F.try_element_at(table, name), by_code)


def unescape(text: Column | str) -> Column:
    """Replace character references; ``&amp;`` last, so ``&amp;lt;`` stays ``&lt;``."""

    def decoded(whole: Column) -> Column:
        names = F.array_distinct(F.regexp_extract_all(whole, F.lit(r"&(#?\w+);"), 1))
        return F.aggregate(
            F.filter(names, lambda n: n != "amp"),
            whole,
            lambda acc, n: F.coalesce(
                F.replace(acc, F.concat(F.lit("&"), n, F.lit(";")), _entity_char(n)), acc
            ),
        )

    def replaced(whole: Column) -> Column:
        return F.when(
            whole.contains("&"), F.replace(once(whole, decoded), F.lit("&amp;"), F.lit("&"))
        ).otherwise(whole)

    return once(_col(text), replaced)


# stand for the start of a row, the start of a cell, and their ends: characters that no text has
_ROW, _CELL, _CELL_END, _ROW_END = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3"
_MARKS = _ROW + _CELL + _CELL_END + _ROW_END


def _pieces(html: Column) -> Column:
    """Text between tags with a cut between pieces, blanks around cuts and marks removed."""
    visible = F.regexp_replace(html, _HIDDEN, _CUT)
    pieces = unescape(F.regexp_replace(visible, _TAG, _CUT))
    joined = F.regexp_replace(pieces, rf"(?U)\s*{_CUT}[\s{_CUT}]*", _CUT)
    return F.regexp_replace(joined, rf"(?U)^[\s{_CUT}]+|[\s{_CUT}]+$", "")


def _text_nodes(html: Column, joiner: str) -> Column:
    """Text between tags, each piece trimmed, empty pieces dropped."""
    return F.replace(_pieces(html), F.lit(_CUT), F.lit(joiner))


def html_text(html: Column | str) -> Column:
    """Visible text of an HTML fragment, pieces joined by one blank; NULL for no input."""
    html = _col(html)
    return F.when(html != "", _text_nodes(html, " "))


def _pairs(entries: Column) -> Column:
    usable = F.filter(entries, lambda e: (e["key"] != "") & (e["value"] != ""))
    return F.map_from_entries(usable)


def html_attributes(html: Column | str) -> Column:
    """Attributes of a description: first table's rows, else ``Key: value`` lines.

    Keys are lower case; a repeated key keeps its last value (session setting LAST_WIN).
    """
    html = _col(html)
    # the table's own tags become marks, so one pass cleans all cells, and splitting finds them
    table = F.regexp_extract(html, r"(?is)<table\b.*?(?:</table|\z)", 0)
    for tag, mark in ((r"<tr\b", _ROW), (r"<t[dh]\b", _CELL), ("</t[dh]", _CELL_END), ("</(?:tr|table)", _ROW_END)):
        table = F.regexp_replace(table, rf"(?is){tag}[^>]*>?", mark)
    cleaned = F.regexp_replace(_pieces(table), rf"(?U)[\s{_CUT}]*([{_MARKS}])[\s{_CUT}]*", "$1")
    rows = F.split(F.replace(cleaned, F.lit(_CUT), F.lit("")), _ROW)

    def row_entry(row: Column) -> Column:
        cells = F.split(F.substring_index(row, _ROW_END, 1), _CELL)
        first, second = (F.substring_index(F.get(cells, F.lit(n)), _CELL_END, 1) for n in (1, 2))
        return F.struct(
            F.coalesce(F.lower(first), F.lit("")).alias("key"), F.coalesce(second, F.lit("")).alias("value")
        )

    def line_entry(line: Column) -> Column:
        key = F.substring_index(line, ":", 1)
        return F.struct(
            F.lower(F.trim(key)).alias("key"),
            F.trim(F.substring(line, F.length(key) + 2, F.length(line))).alias("value"),
        )

    # what stands before the first row is none
    from_table = _pairs(F.transform(F.slice(rows, F.lit(2), F.size(rows)), row_entry))
    lines = F.filter(F.split(_text_nodes(html, "\n"), "\n"), lambda line: line.contains(":"))
    from_lines = _pairs(F.transform(lines, line_entry))
    found = once(from_table, lambda pairs: F.when(F.size(pairs) > 0, pairs).otherwise(from_lines))
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(found, empty)


def attribute(attributes: Column, *words: str) -> Column:
    """First attribute whose key contains a word; words in order, then attributes in order."""
    entries = F.map_entries(attributes)

    def first_hit(word: str) -> Column:
        return F.get(F.filter(entries, lambda e: F.lower(e["key"]).contains(word)), F.lit(0))["value"]

    return F.coalesce(*[first_hit(word.lower()) for word in words])
