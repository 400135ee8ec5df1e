"""Status vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from canteiro import vocab
from canteiro.functions.numbers import amount
from canteiro.functions.text import _col, contains_any, first_listed, fold, strip
from canteiro.functions.dates import (
    elapsed_percent,
    expected_end,
    month_and_year,
    status_by_end,
)

def official_status(raw: Column | str) -> Column:
    """Raw status to the official vocabulary; an unknown spelling is kept as written.

    Case does not matter, accents do. Set tests per official value, so no join and no shuffle.
    """
    trimmed = strip(raw)
    lowered = F.lower(trimmed)
    status = F.when(F.coalesce(lowered.isin(*vocab.MISSING_TOKENS), F.lit(True)), vocab.UNDEFINED_STATUS)
    for official, spellings in vocab.STATUS_SPELLINGS.items():
        status = status.when(lowered.isin(*spellings), official)
    return status.otherwise(trimmed)


def contract_status(raw: Column | str, end: Column | str, as_of: Column) -> Column:
    """Published status, else the one the end date implies."""
    raw = _col(raw)
    absent = F.coalesce(F.lower(raw).isin("", "nan", "none"), F.lit(True))
    return F.when(absent, status_by_end(end, as_of)).otherwise(raw)


def tender_status(opinion: Column | str, approved_on: Column | str) -> Column:
    """Published opinion, else approved when an approval date exists."""
    return F.coalesce(
        _col(opinion),
        F.when(_col(approved_on).isNotNull(), "Homologada").otherwise(vocab.UNDEFINED_STATUS),
    )


def agreement_cancelled(status: Column | str) -> Column:
    return contains_any(fold(status, trim=False), vocab.CANCELLED_WORDS)


def agreement_settled(status: Column | str) -> Column:
    """Agreement that ended in completion rather than cancellation."""
    folded = fold(status, trim=False)
    return contains_any(folded, vocab.SETTLED_WORDS) & ~agreement_cancelled(status)


def has_amendment(
    count: Column | str, value: Column | str, last_date: Column | str, flag: Column | str
) -> Column:
    """An amendment is known by its count, its value, its date or the record's flag."""
    false = F.lit(False)
    dated = _col(last_date).isNotNull() & ~_col(last_date).cast("string").isin("", "null")
    return (
        F.coalesce(amount(count, "comma_decimal") > 0, false)
        | F.coalesce(amount(value, "comma_decimal") > 0, false)
        | dated
        | F.coalesce(fold(flag).contains("aditiv"), false)
    )


def is_active_work(
    status: Column | str, deadline: Column | str, start: Column | str, as_of: Column
) -> Column:
    """Running by status, or with a start or deadline within the last two years, and not over."""
    lowered = F.lower(_col(status))
    since = as_of - F.expr(f"INTERVAL {vocab.ACTIVE_WINDOW_DAYS} DAYS")
    false = F.lit(False)
    recent = F.coalesce(_col(deadline) >= since, false) | F.coalesce(_col(start) >= since, false)
    running = contains_any(lowered, vocab.ACTIVE_WORDS)
    over = contains_any(lowered, vocab.OVER_WORDS)
    return (running | recent) & ~over


def _stage(text: Column, running_words: tuple[str, ...]) -> Column:
    stages = (
        (vocab.FINISHED_WORDS, "concluída"),
        (running_words, "em andamento"),
        (vocab.HALTED_WORDS, "paralisada"),
        (vocab.PLANNED_WORDS, "planejada"),
    )
    choices = [(word, stage) for words, stage in stages for word in words]
    return first_listed(text, choices, F.lit(None).cast("string"))


def marker_status(attributes: Column, marker: Column, layer: Column) -> Column:
    """Status of a map marker: its own attribute, then other attributes, icon, layer."""
    own = _stage(F.lower(F.try_element_at(attributes, F.lit("obra"))), vocab.RUNNING_WORDS)
    entries = F.map_entries(attributes)
    broad = (*vocab.RUNNING_WORDS, "obra")

    def named(word: str) -> Column:
        return F.filter(entries, lambda e: F.lower(e["key"]).contains(word))

    values = F.transform(F.concat(named("status"), named("situação")), lambda e: e["value"])
    joined = F.lower(F.array_join(values, " "))
    icon = F.lower(marker)
    by_icon = F.nullif(first_listed(icon, list(vocab.MARKER_STATUS), F.lit("indefinido")), F.lit("indefinido"))
    by_other = _stage(joined, broad)
    return F.coalesce(own, by_other, by_icon, _stage(F.lower(layer), broad), F.lit("indefinido"))


def marker_percent(attributes: Column, as_of: Column) -> Column:
    """Percent of a map marker: 100 when finished, elapsed share while running."""
    status = F.upper(F.try_element_at(attributes, F.lit("obra")))
    first = F.try_element_at(attributes, F.lit("início"))
    start_text = F.coalesce(F.when(first != "", first), F.try_element_at(attributes, F.lit("inicio")))
    start = month_and_year(start_text)
    end = expected_end(F.try_element_at(attributes, F.lit("fim")), start)
    running = contains_any(status, vocab.MARKER_RUNNING_WORDS)
    return F.when(contains_any(status, vocab.MARKER_FINISHED_WORDS), F.lit(100.0)).when(
        running & (end > start), elapsed_percent(start, end, as_of)
    )


def panel_percent(
    status: Column, given: Column, start: Column, deadline: Column, as_of: Column
) -> Column:
    """Percent of a panel row with fallbacks by words in its raw status."""
    lowered = F.lower(strip(status))
    by_time = F.coalesce(elapsed_percent(start, deadline, as_of), F.lit(0.0))
    fallback = (
        F.when(F.coalesce(status == "", F.lit(True)), F.lit(None).cast("double"))
        .when(contains_any(lowered, vocab.PANEL_FINISHED_WORDS), F.lit(100.0))
        .when(
            contains_any(lowered, vocab.PANEL_PLANNED_WORDS),
            F.lit(0.0),
        )
        .when(contains_any(lowered, vocab.PANEL_RUNNING_WORDS), by_time)
        .otherwise(F.lit(0.0))
    )
    return F.when(given >= 0, given).otherwise(fallback)


def health_percent(given: Column, status: Column) -> Column:
    """Percent of a health work: the source's, else 100 when done, else 0."""
    done = contains_any(F.lower(status), vocab.HEALTH_FINISHED_WORDS)
    return F.coalesce(given, F.when(done, F.lit(100.0)).otherwise(F.lit(0.0)))
