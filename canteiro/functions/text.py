"""Text cleaning, folding and extraction."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from canteiro import vocab

WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    """Trim blanks, tabs, line ends and no-break spaces on both sides."""
    return F.btrim(_col(text), F.lit(WHITESPACE))


def blank_to_null(text: Column | str) -> Column:
    text = _col(text)
    return F.when(strip(text) != "", text)


def is_blank(text: Column | str) -> Column:
    """True for NULL and for text made of blanks only."""
    return F.coalesce(strip(text) == "", F.lit(True))


def is_missing(text: Column | str) -> Column:
    """Cleaner rule: NULL, blank, or one of the missing tokens (case kept)."""
    return F.coalesce(strip(text).isin(*vocab.MISSING_TOKENS), F.lit(True))


def missing_to_null(text: Column | str) -> Column:
    text = _col(text)
    return F.when(~is_missing(text), text)


def text_or_null(
    text: Column | str,
    null_texts: Iterable[str] = vocab.NULL_TEXTS_COURT,
    ignore_case: bool = False,
) -> Column:
    """Trimmed text; NULL when it is one of ``null_texts``."""
    trimmed = strip(text)
    probe = F.lower(trimmed) if ignore_case else trimmed
    return F.when(~probe.isin(*null_texts), trimmed)


# stands for a letter with a long form; a private character, so hardly a text has it
_LONG = "\ue000"


@cache
def _fold_table() -> tuple[str, str]:
    """Letters whose compatibility form without marks is one other character, then the marks to delete.

    Derived from the Unicode data of the standard library for the Basic Multilingual Plane.
    """
    source, target, marks = [], [], []
    for code, char, plain in _plain_forms():
        if not plain:
            marks.append(char)
        elif len(plain) == 1 and plain != char:
            source.append(char)
            target.append(plain)
    return "".join(source + marks), "".join(target)


def _plain_forms() -> Iterator[tuple[int, str, str]]:
    """Code, character and lower-case compatibility form without marks, beyond ASCII."""
    for code in range(0x80, 0x10000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if plain != char:
            yield code, char, plain.lower()


@cache
def _long_forms() -> tuple[tuple[str, str], ...]:
    """Letters whose form has several letters or digits, such as ligatures and Roman numerals."""
    return tuple((c, plain) for _, c, plain in _plain_forms() if len(plain) > 1 and plain.isascii() and plain.isalnum())


@cache
def _long_table() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Letters with a long form, the first letters of the forms, and the letters by the rest of their form."""
    forms = _long_forms()
    rests: dict[str, str] = {}
    for char, plain in forms:
        rests[plain[1:]] = rests.get(plain[1:], "") + char
    return "".join(c for c, _ in forms), "".join(plain[0] for _, plain in forms), tuple(sorted(rests.items()))


def _expanded(text: Column) -> Column:
    """Letters with a form of several characters, replaced: first the rest of the form is put behind each, then
    the letters become the first of their form."""
    letters, firsts, rests = _long_table()
    for rest, chars in rests:
        text = F.regexp_replace(text, f"([{chars}])", f"$1{rest}")
    return F.translate(text, letters, firsts)


def fold(text: Column | str, trim: bool = True) -> Column:
    """Lower case without accents, for comparisons."""
    source, target = _fold_table()
    letters = _long_table()[0]
    lowered = F.lower(strip(text) if trim else _col(text))
    plain = F.octet_length(lowered) == F.length(lowered)  # ASCII only, nothing to translate
    # few texts hold a letter with a long form; one pass translates, and marks those that do
    cut = len(target)
    marked = F.translate(lowered, source[:cut] + letters + source[cut:], target + _LONG * len(letters))
    long = marked.contains(_LONG)
    return F.when(plain, lowered).when(long, _expanded(F.translate(lowered, source, target))).otherwise(marked)


def fold_upper(text: Column | str) -> Column:
    """Upper case without accents, inner blanks squeezed."""
    return F.upper(strip(F.regexp_replace(fold(text), r"\s+", " ")))


def key_form(text: Column | str) -> Column:
    """Letters and digits only, folded: the form in which names are compared as keys."""
    return F.regexp_replace(fold(text), "[^a-z0-9]+", "")


def slug(text: Column | str) -> Column:
    return F.btrim(F.regexp_replace(fold(text), "[^a-z0-9]+", "_"), F.lit("_"))


def fold_name(name: str) -> str:
    """Folding of a column name on the driver (schema only, never data)."""
    plain = unicodedata.normalize("NFKD", name.strip().lower())
    return "".join(c for c in plain if not unicodedata.combining(c))


def key_name(name: str) -> str:
    return "".join(c for c in fold_name(name) if c.isascii() and c.isalnum())


def slug_name(name: str) -> str:
    spaced = "".join(c if c.isascii() and c.isalnum() else " " for c in fold_name(name))
    return "_".join(spaced.split())


def contains_any(text: Column | str, words: Sequence[str]) -> Column:
    """True when ``text`` holds any of the words; NULL text gives False.

    One pattern of all words, so the text is computed and scanned once.
    """
    return F.coalesce(_col(text).rlike(words_pattern(words)), F.lit(False))


def _branches(words: Sequence[str]) -> str:
    """Pattern of the words with their common beginnings written once, the longest word first."""
    heads: dict[str, list[str]] = {}
    for word in words:
        if word:
            heads.setdefault(word[0], []).append(word[1:])
    parts = [re.escape(head) + _branches(rests) for head, rests in sorted(heads.items())]
    if not parts:
        return ""
    body = parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"
    return f"(?:{body})?" if "" in words else body


def words_pattern(words: Iterable[str]) -> str:
    """Pattern of any of the words: a trie, so a place in the text is tried once however many words there are."""
    return _branches(sorted(set(words)))


def words_found(text: Column, words: Iterable[str]) -> Column:
    """The longest of the words at each place of the text where one begins, in one pass; words may overlap."""
    return F.regexp_extract_all(text, F.lit(f"(?=({words_pattern(words)}))"), F.lit(1))


def first_listed(text: Column, choices: Sequence[tuple[str, object]], default: Column) -> Column:
    """Value of the first word of the list that the text holds, wherever it stands; the text is scanned once."""
    words = [word for word, _ in choices]

    def choose(found: Column) -> Column:
        chosen = None
        for word, value in choices:
            # a longer word that begins at the same place stands for this one too
            holders = F.array(*[F.lit(other) for other in words if word in other])
            hit = F.arrays_overlap(found, holders)
            chosen = F.when(hit, F.lit(value)) if chosen is None else chosen.when(hit, F.lit(value))
        return chosen.otherwise(default)

    return once(words_found(text, words), choose)


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value computed once however often the body uses it.

    For bodies that are higher-order functions already; plain expressions are better shared as a
    column of an earlier projection.
    """
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def mentions_works(text: Column | str, keywords: Sequence[str] = vocab.WORKS_KEYWORDS) -> Column:
    """Public-works keyword test: lower case, accents matter, plain substring."""
    return contains_any(F.lower(_col(text)), keywords)


def same_text(left: Column | str, right: Column | str) -> Column:
    """Equality that ignores case and accents; NULL compares as empty text."""
    empty = F.lit("")
    return F.coalesce(fold(left), empty) == F.coalesce(
        fold(F.lit(right) if isinstance(right, str) else right), empty
    )


def digits_only(text: Column | str) -> Column:
    """The digits of a text; NULL when there are none."""
    digits = F.regexp_replace(_col(text), r"\D", "")
    return F.when(digits != "", digits)


def _title(text: Column) -> Column:
    """Capital after any character that is not a letter, lower case elsewhere."""
    marked = F.regexp_replace(F.lower(text), r"([^\p{L}\s])(?=\p{L})", "$1\u0001 ")
    return F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))


def _first_group(text: Column | str, pattern: str) -> Column:
    found = F.regexp_extract(_col(text), "(?iU)" + pattern, 1)
    return F.btrim(F.regexp_replace(found, r"(?U)\s+", " "), F.lit(" .,-"))


def district_in_text(text: Column | str) -> Column:
    """District named in a contract object, in title case; NULL when none is found."""
    found = _title(_first_group(text, vocab.DISTRICT_PATTERN))
    return F.when(found != "", found)


def street_in_text(text: Column | str) -> Column:
    """Street named in a contract object; NULL when none is found."""
    found = _first_group(text, vocab.STREET_PATTERN)
    return F.when(found != "", found)


def district_after_word(text: Column | str) -> Column:
    """Looser form: what follows BAIRRO up to a comma, the municipality or the state."""
    tail = F.regexp_extract(_col(text), r"(?iU)\bBAIRRO\s+([^,]+)", 1)
    tail = F.regexp_replace(tail, r"(?isU)\bMACA[EÉ]\b.*", "")
    tail = strip(F.regexp_replace(tail, r"(?isU)\bRJ\b.*", ""))
    return F.when(tail != "", tail)
