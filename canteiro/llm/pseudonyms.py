r"""Format-preserving pseudonyms for personal data in texts.

Numbers and dates are found by their form, validated, and replaced by a keyed permutation within the same form: a card
number becomes a card number with a right check digit and the same separators, a date another date. Equal values get
equal pseudonyms in every document, and different values different ones, so records stay linked. Mail addresses and
secrets have no number to permute; they get a keyed digest in their form.

| kind | validated by | stays |
|---|---|---|
| card | 13 to 19 digits, Luhn check | first digit, length, separators; new check digit |
| phone | separators, or + and 8 to 15 digits in groups | country code, layout; area and exchange codes stay valid |
| social | ddd-dd-dddd | layout |
| address | four numbers up to 255 | layout |
| date | calendar, years 1900 to 2099 | layout, order of day and month |
| mail, key, secret | form | kind, length of key and secret |

A text is cut at the matches of one pattern, the matches are replaced, and the parts are joined again; texts without a
match stay as they are. Pattern parts are possessive or bounded, so the search is linear in the text. The key is a
literal of the plan: do not publish plans made with a real key.

Defined cases: a NULL text stays NULL, an empty text empty, both with no findings; rows that repeat get the same
result; other columns are kept; an empty table gives an empty table. Everything is built-in column code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.llm.common import let, whole_part
from canteiro.llm.feistel import RoundHash, permuted, permuted_pair, secret

KINDS = ("mail", "key", "secret", "address", "date", "social", "card", "phone")

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_YEAR, _MONTH, _DAY = "(?:19|20)[0-9]{2}", "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12][0-9]|3[01])"
# a mail takes the whole run of its local part; a name has up to 253 characters, so up to 126 labels
_LOCAL = r"A-Za-z0-9\u00C0-\u024F._%+'\-"
MAIL = (
    rf"(?<![{_LOCAL}])[{_LOCAL}]++@(?:[A-Za-z0-9\u00C0-\u024F\-]++\.){{1,126}}(?:xn--[A-Za-z0-9\-]{{1,59}}|[A-Za-z]{{2,63}})"
)
# signs before the first letter or digit of a mail are not part of it
_BEFORE_MAIL = r"^[._%+'\-]+(?=[^._%+'\-@])"
KEY = r"\bAKIA[0-9A-Z]{16}\b"
# a value goes to its closing quote on the line, else to white space or a quote that ends a word
_QUOTED = r"{q}[^{q}\\\r\n]*+(?:\\.[^{q}\\\r\n]*+){{0,200}}(?={q})"
SECRET = (
    r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|passphrase|passcode|secret|token|api[_\-]?key)(?:\\{0,3}[\"'])?[\x20\t]*+[=:]{1,2}>?[\x20\t]*+"
    + "(?:" + _QUOTED.format(q='"') + "|" + _QUOTED.format(q="'")
    + r"|[\"']?(?=\S{6})[^\s\"']++(?:[\"'](?=[A-Za-z0-9])[^\s\"']*+){0,200})"
)
LEAST_SECRET = 6
ADDRESS = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
DATE = (
    rf"(?<![0-9/.\-])(?:{_YEAR}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])|{_DAY}[/.]{_MONTH}[/.]{_YEAR}"
    rf"|{_MONTH}/(?:1[3-9]|2[0-9]|3[01])/{_YEAR})(?![0-9/\-])"
)
SOCIAL = r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ \-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})(?![0-9])"
PHONE = (
    r"(?<![0-9A-Za-z+])(?:(?:\+1[ .\-]?)?(?:\([0-9]{3}\)[ .\-]?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}"
    r"|\+[0-9](?:(?:[ .\-/]?\(|\)[ .\-/]?|[ .\-/])?[0-9]){7,14})(?![0-9])"
)
_CARD_IN_PATTERN = CARD.replace(r"([ \-])", r"(?<gap>[ \-])").replace(r"\1", r"\k<gap>")
PATTERN = f"{MAIL}|{KEY}|{SECRET}|(?=[0-9+(])(?:{ADDRESS}|{DATE}|{SOCIAL}|{_CARD_IN_PATTERN}|{PHONE})"

FIRST_DAY, DAYS = "1900-01-01", 73_049  # to 2099-12-31


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum; digits at odd places from the right are doubled if ``doubled`` is 1, else those at even places."""
    places = F.sequence(F.lit(1), F.char_length(digits))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(F.reverse(digits), place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(F.pmod(place, F.lit(2)) == doubled, twice).otherwise(digit)

    return F.aggregate(places, F.lit(0), add)


def is_card(text: Column) -> Column:
    return let(_digits(text), lambda d: F.pmod(_luhn_sum(d, 0), F.lit(10)) == 0)


def _padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width if isinstance(width, Column) else F.lit(width), F.lit("0"))


def _laid_out(form: Column, digits: Column) -> Column:
    """The form with its digits replaced, in order."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("next"))

    def put(state: Column, character: Column) -> Column:
        is_digit = character.rlike("^[0-9]$")
        new = F.when(is_digit, F.substring(digits, state["next"], F.lit(1))).otherwise(character)
        return F.struct(
            F.concat(state["text"], new).alias("text"),
            F.when(is_digit, state["next"] + 1).otherwise(state["next"]).alias("next"),
        )

    return F.aggregate(F.split(form, ""), start, put)["text"]


def _permuted_digits(digits: Column, of: RoundHash) -> Column:
    """Digits of any length up to 18, permuted among the numbers of that length, leading zeros included."""

    def of_length(length: int) -> Column:
        right = length // 2
        left = length - right
        pair = permuted_pair(
            F.substring(digits, 1, left).cast("long"),
            F.substring(digits, left + 1, right).cast("long"),
            10**left,
            10**right,
            of,
        )
        return let(pair, lambda p: F.concat(_padded(p["l"], left), _padded(p["r"], right)))

    choices = digits
    for length in range(2, 19):
        choices = F.when(F.char_length(digits) == length, of_length(length)).otherwise(choices)
    return choices


def _card(text: Column, of: RoundHash) -> Column:
    def numbered(digits: Column) -> Column:
        middle = F.substring(digits, F.lit(2), F.char_length(digits) - 2)
        body = F.concat(F.substring(digits, 1, 1), _permuted_digits(middle, of))
        check = lambda b: F.pmod(10 - F.pmod(_luhn_sum(b, 1), F.lit(10)), F.lit(10))
        return let(body, lambda b: _laid_out(text, F.concat(b, check(b).cast("string"))))

    return let(_digits(text), numbered)


def _phone(text: Column, of: RoundHash) -> Column:
    """Ten digits, after 1 or nothing, with valid area and exchange codes; else all digits after the country code."""

    def numbered(digits: Column) -> Column:
        n = F.char_length(digits)
        country, area = F.substring(digits, F.lit(1), n - 10), F.substring(digits, n - 9, F.lit(3)).cast("long")
        exchange, line = F.substring(digits, n - 6, F.lit(3)).cast("long"), F.substring(digits, n - 3, F.lit(4)).cast("long")
        pair = permuted_pair(area - 200, (exchange - 200) * 10_000 + line, 800, 8_000_000, of)
        valid = let(
            pair, lambda p: F.concat(country, _padded(p["l"] + 200, 3), _padded(p["r"] + 2_000_000, 7))
        )
        code = F.char_length(F.regexp_extract(text, r"^\+([0-9]{1,3})(?![0-9])", 1))
        kept = F.when(~text.startswith("+"), 0).when(code > 0, code).otherwise(2)
        other = F.concat(
            F.substring(digits, F.lit(1), kept), _permuted_digits(F.substring(digits, kept + 1, n), of)
        )
        fits = ((n == 10) & ~text.startswith("+") | (n == 11) & digits.startswith("1")) & (area >= 200) & (exchange >= 200)
        return _laid_out(text, F.when(fits, valid).otherwise(other))

    return let(_digits(text), numbered)


def _social(text: Column, of: RoundHash) -> Column:
    return let(_digits(text), lambda d: _laid_out(text, _permuted_digits(d, of)))


def _address(text: Column, of: RoundHash) -> Column:
    def numbered(parts: Column) -> Column:
        at = lambda k: F.get(parts, F.lit(k)).cast("long")
        pair = permuted_pair(at(0) * 256 + at(1), at(2) * 256 + at(3), 65_536, 65_536, of)
        halves = lambda x: (whole_part(x, 256).cast("string"), F.pmod(x, F.lit(256)).cast("string"))
        return let(pair, lambda p: F.concat_ws(".", *halves(p["l"]), *halves(p["r"])))

    return let(F.split(text, r"\."), numbered)


def _day_of(text: Column) -> tuple[Column, Column, Column]:
    """Day, month order flag and separator of a date text."""
    iso = text.rlike("^[0-9]{4}-")
    parts = F.split(text, r"[/.\-]")
    month_first = ~iso & (F.get(parts, F.lit(1)).cast("int") > 12)
    year = F.when(iso, F.get(parts, F.lit(0))).otherwise(F.get(parts, F.lit(2)))
    month = F.when(iso, F.get(parts, F.lit(1))).when(month_first, F.get(parts, F.lit(0))).otherwise(F.get(parts, F.lit(1)))
    day = F.when(iso, F.get(parts, F.lit(2))).when(month_first, F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(0)))
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))), iso, month_first


def _date(text: Column, of: RoundHash) -> Column:
    """Another day in the same layout; a text that is no day of the calendar stays."""
    day, iso, month_first = _day_of(text)
    first = F.lit(FIRST_DAY).cast("date")
    moved = F.date_add(first, permuted(F.datediff(day, first), DAYS, of).cast("int"))
    gap = F.when(text.contains("/"), F.lit("/")).otherwise(F.lit("."))
    laid = lambda d: (
        F.when(iso, F.date_format(d, "yyyy-MM-dd"))
        .when(month_first, F.concat_ws("/", F.month(d), F.dayofmonth(d), F.year(d)))
        .otherwise(F.concat(F.lpad(F.dayofmonth(d), 2, "0"), gap, F.lpad(F.month(d), 2, "0"), gap, F.year(d)))
    )
    return F.coalesce(let(moved, laid), text)


def _digest(key: str, text: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), text), 256)


def _secret_parts(text: Column) -> tuple[Column, Column]:
    """What stands before the value of a secret, and the value."""
    head = F.regexp_extract(text, r"^[^=:]*[=:]{1,2}>?[\x20\t]*[\"']?", 0)
    return head, F.substring(text, F.char_length(head) + 1, F.char_length(text))


def is_secret(text: Column) -> Column:
    """A word of letters alone is no secret."""
    value = _secret_parts(text)[1]
    return (F.char_length(value) >= LEAST_SECRET) & value.rlike("[0-9@]|AKIA")


def _secret(text: Column, key: str) -> Column:
    """The digest of the value, repeated up to the value's length."""
    head, value = _secret_parts(text)
    times = whole_part(F.char_length(value), 64).cast("int") + 1
    return F.concat(head, F.substring(F.repeat(_digest(key, value), times), F.lit(1), F.char_length(value)))


def _mail(text: Column, key: str) -> Column:
    before = F.regexp_extract(text, _BEFORE_MAIL, 0)
    mail = F.substring(text, F.char_length(before) + 1, F.char_length(text))
    return F.concat(before, F.lit("u"), F.substring(_digest(key, F.lower(mail)), 1, 16), F.lit("@mail.invalid"))


def kind_of(match: Column) -> Column:
    """Kind of a match of the pattern; NULL when it isn't valid."""
    whole = lambda pattern: match.rlike(rf"^(?:{pattern})$")
    return (
        F.when(match.rlike("[=:]"), F.when(is_secret(match), "secret"))
        .when(match.contains("@"), "mail")
        .when(whole(KEY), "key")
        .when(whole(ADDRESS), "address")
        .when(whole(DATE), F.when(_day_of(match)[0].isNotNull(), "date"))
        .when(whole(SOCIAL), "social")
        .when(whole(CARD), F.when(is_card(match), "card"))
        .otherwise("phone")
    )


def pseudonym(kind: Column, match: Column, key: str) -> Column:
    """The pseudonym of a match of a kind; the match itself without a kind."""
    of = secret(key)
    letters = F.translate(F.substring(_digest(key, match), 1, 16), "0123456789abcdef", "ABCDEFGHIJKLMNOP")
    return (
        F.when(kind.isNull(), match)
        .when(kind == "mail", _mail(match, key))
        .when(kind == "key", F.concat(F.lit("AKIA"), letters))
        .when(kind == "secret", _secret(match, key))
        .when(kind == "address", _address(match, of))
        .when(kind == "date", _date(match, of))
        .when(kind == "social", _social(match, of))
        .when(kind == "card", _card(match, of))
        .otherwise(_phone(match, of))
    )


def _count(found: Column, kind: str) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.size(F.filter(found, lambda f: f["kind"] == kind)).alias("n"))


def pseudonymized(documents: DataFrame, key: str, text_column: str = "text") -> DataFrame:
    """The documents with pseudonyms in their texts and a map of findings by kind in ``findings``.

    A column named ``findings`` is replaced.
    """
    text = F.col(f"`{text_column}`")
    kinds = F.transform(
        F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), lambda m: F.struct(kind_of(m).alias("kind"), m.alias("m"))
    )

    def replaced(found: Column) -> Column:
        new = F.concat(F.transform(found, lambda f: pseudonym(f["kind"], f["m"], key)), F.array(F.lit("")))
        parts = F.zip_with(F.split(text, PATTERN, -1), new, lambda part, m: F.concat(part, m))
        counts = F.map_from_entries(
            F.filter(F.array(*[_count(found, kind) for kind in KINDS]), lambda entry: entry["n"] > 0)
        )
        unchanged = F.struct(text.alias("text"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>")).alias("findings"))
        return F.when(F.coalesce(F.size(found), F.lit(0)) <= 0, unchanged).otherwise(
            F.struct(F.array_join(parts, "").alias("text"), counts.alias("findings"))
        )

    # the user's columns travel in a struct, so no name of theirs meets one of ours
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    made = documents.select(whole.alias("__row"), let(kinds, replaced).alias("__made"))
    cells = [
        F.col("__made.text").alias(c) if c == text_column else F.col("__row").getField(c).alias(c)
        for c in documents.columns
        if c != "findings"
    ]
    return made.select(*cells, F.col("__made.findings").alias("findings"))
