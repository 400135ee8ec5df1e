"""Landed datasets into raw tables, one run-log line per dataset."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canteiro.operators.dedup import SOURCE_POSITION
from canteiro.operators.fields import absent_columns, conform, keep_columns, raw_payload, rename_guarded, with_defaults
from canteiro.operators.merge import KEPT, OUTCOME, REJECTED, VersionedTable, marked_batch, prepare_batch, staged_rows
from canteiro.operators.records import has_records
from canteiro.plans.cleaning import clean, roles_by_schema, with_dates
from canteiro.routes import ROUTES, Route, check_routes, column_names, table_schema
from canteiro.sources.common import UNREADABLE, record_columns
from canteiro.sources.files import CORRUPT, datasets, read_by_suffix

RUN_LOG = (
    "dataset string, fonte string, status string, qtd_lidos bigint, qtd_registros bigint, "
    "qtd_substituidos bigint, qtd_erros bigint, duracao_segundos double, mensagem string, "
    "datas_ilegiveis map<string,bigint>"
)
REJECTS = "rejeitados"

Normaliser = Callable[[DataFrame, Column], DataFrame]


def apply_route(df: DataFrame, route: Route) -> DataFrame:
    """Guarded renames, defaults for blank cells, and the route's source name."""
    renamed = rename_guarded(df, route.renames)
    return with_defaults(renamed, route.defaults).withColumn("fonte", F.lit(route.source))


def source_order(df: DataFrame) -> tuple[str, ...]:
    """Columns that give the rows' order in their source."""
    return tuple(name for name in (*SOURCE_POSITION, "_item") if name in df.columns)


def routed_rows(
    df: DataFrame, route: Route, as_of: Column, order: tuple[str, ...] = (), seen: Observation | None = None
) -> DataFrame:
    """Cleaned rows in the columns of the raw table, order columns still attached.

    The raw record is kept as JSON after routing, so an earlier one nests inside it. ``seen``
    observes the rows read (``n``) and, for each column of dates, the cells that give no date.
    """
    order = order or source_order(df)
    schema = table_schema(route.table)
    roles = roles_by_schema([n for n in df.columns if n not in (*order, UNREADABLE)], schema, route.renames)
    df = with_dates(df, roles.dates)
    if seen is not None:
        dates = [n for n in column_names(route.table) if isinstance(schema[n].dataType, T.TimestampType)]
        named = dict.fromkeys([*roles.dates, *dates])
        lost = [F.count_if(F.array_contains(UNREADABLE, n)).alias(n) for n in named]
        df = df.observe(seen, F.count(F.lit(1)).alias("n"), *lost)
    routed = apply_route(clean(df.drop(UNREADABLE), as_of, roles, order), route)
    missing = absent_columns(routed, route.keys)
    if missing:
        raise ValueError(f"no key column {missing} for {route.table}")
    stamped = routed.withColumns(
        {"payload_bruto": raw_payload(routed.drop(*order)), "coletado_em": as_of.cast("timestamp")}
    )
    kept = keep_columns(stamped, (*column_names(route.table), *order))
    types = {f.name: f.dataType for f in schema.fields}
    return kept.select(*[F.col(n).cast(types[n]).alias(n) if n in types else F.col(n) for n in kept.columns])


def raw_rows(
    df: DataFrame, route: Route, as_of: Column, order: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Rows ready for the raw table, unique by its key, and the rejected rows."""
    order = order or source_order(df)
    rows = routed_rows(df, route, as_of, order)
    batch, rejected = prepare_batch(rows, route.keys, order or list(route.keys))
    return batch.drop(*order), rejected.drop(*order)


def marked_rows(
    df: DataFrame, route: Route, as_of: Column, order: tuple[str, ...] = (), seen: Observation | None = None
) -> DataFrame:
    """Rows of the raw table, unique by its key, and those without a key, each marked with its outcome."""
    order = order or source_order(df)
    rows = routed_rows(df, route, as_of, order, seen)
    return marked_batch(rows, route.keys, order or list(route.keys)).drop(*order)


def _listed_rejects(rejected: DataFrame, reason: str) -> DataFrame:
    """Rejected rows in the columns of the reject table."""
    if "payload_bruto" in rejected.columns:
        record = F.col("payload_bruto")
    elif CORRUPT in rejected.columns:
        record = F.col(CORRUPT)
    else:
        record = raw_payload(rejected)
    return rejected.select(F.lit(reason).alias("motivo"), record.alias("registro"))


def load_dataset(
    spark: SparkSession,
    name: str,
    source: DataFrame | Callable[[], tuple[DataFrame, DataFrame]],
    root: str,
    as_of: Column,
    routes: Mapping[str, Route] = ROUTES,
    normalisers: Mapping[str, Normaliser] | None = None,
    staging: str | None = None,
) -> tuple:
    """Upsert one dataset into its raw table; returns its run-log line.

    ``source`` is a frame, or a reader that gives rows and unreadable records; reading and parsing
    happen inside the isolation, so a bad file is a line of the log. One pass over the rows cleans
    and deduplicates them, counts them, and stages them below ``staging`` (default: below the raw
    root) by their outcome; they are merged, or listed as rejects, from there. The line counts, for
    each column of dates, the cells that give no date. Each source of a raw table is a versioned table of its own, so a load rewrites one
    source. Rows without a key and unreadable records go to the table ``rejeitados`` with their
    reason; rows read = written + replaced by later rows of their key + rejected. Required columns
    that are absent are named in the line and do not stop the load.
    """
    route = routes.get(name)
    if route is None:
        return (name, None, "ignorado", 0, 0, 0, 0, 0.0, "no route", None)
    started = time.monotonic()
    staged = staged_rows(spark, name, staging or f"{root}/_staging")
    unread_rows = staged_rows(spark, f"{name}-unread", staging or f"{root}/_staging")
    spent = lambda: round(time.monotonic() - started, 3)
    try:
        df, unread = source() if callable(source) else (source, None)
        n_unread = 0
        if unread is not None:
            found = Observation()
            unread_rows.write(_listed_rejects(unread, "registro ilegível").observe(found, F.count(F.lit(1)).alias("n")))
            n_unread = found.get["n"]
        if n_unread:
            _keep_rejects(unread_rows.read(), name, route, root, as_of)
        if not record_columns(df) and not has_records(df):
            return (name, route.source, "vazio", n_unread, 0, 0, n_unread, spent(), None, None)
        if normalisers and name in normalisers:
            df = normalisers[name](df, as_of)
        seen, done = Observation(), Observation()
        order = source_order(df)
        marked = marked_rows(df, route, as_of, order, seen)
        outcome = F.col(OUTCOME)
        counted = marked.observe(
            done, F.count_if(outcome == KEPT).alias("kept"), F.count_if(outcome == REJECTED).alias("rejected")
        )
        # one pass cleans, deduplicates, marks and counts; what follows reads the outcome it wants
        staged.write(counted, OUTCOME)
        read, (written, without_key) = seen.get["n"], (done.get["kept"], done.get["rejected"])
        if not read:
            return (name, route.source, "vazio", n_unread, 0, 0, n_unread, spent(), None, None)
        rows = staged.read()
        batch = rows.where(outcome == KEPT).drop(OUTCOME)
        table = VersionedTable(spark, f"{root}/{route.table}/{route.source}")
        if not table.versions():
            table.write(conform(batch, table_schema(route.table)), route.keys)
        else:
            table.upsert(batch, route.keys)
        if without_key:
            rejected = rows.where(outcome == REJECTED).drop(OUTCOME)
            _keep_rejects(_listed_rejects(rejected, "sem chave"), name, route, root, as_of)
        counts = (read + n_unread, written, read - written - without_key, without_key + n_unread)
        absent = absent_columns(df, [n for n in route.required if n != "fonte" and n not in batch.columns])
        message = f"colunas ausentes: {', '.join(absent)}" if absent else None
        dates = {column: n for column, n in seen.get.items() if column != "n" and n}
        return (name, route.source, "ok", *counts, spent(), message, dates or None)
    except Exception as error:  # one bad dataset must not stop the others
        return (name, route.source, "erro", 0, 0, 0, 1, spent(), str(error), None)
    finally:
        staged.discard()
        unread_rows.discard()


def _keep_rejects(rejects: DataFrame, name: str, route: Route, root: str, as_of: Column) -> None:
    """Append rejected records to the reject table."""
    rejects.select(
        F.lit(name).alias("dataset"),
        F.lit(route.source).alias("fonte"),
        "motivo",
        "registro",
        as_of.cast("timestamp").alias("executado_em"),
    ).write.mode("append").parquet(f"{root}/{REJECTS}")


def ingest_folder(
    spark: SparkSession,
    folder: str,
    root: str,
    as_of: Column,
    normalisers: Mapping[str, Normaliser] | None = None,
    staging: str | None = None,
    by_record: Collection[str] = (),
) -> DataFrame:
    """Every landed dataset of a folder; the run log of this run is returned and appended.

    Records are expected in normal form; for extracts as the sources give them pass
    ``canteiro.plans.extracts.NORMALISERS``. Datasets in ``by_record`` (those of
    ``canteiro.plans.extracts.BY_RECORD``) are read as records, without looking for a schema.
    """
    problems = check_routes()
    if problems:
        raise ValueError("; ".join(problems))
    lines = [
        load_dataset(
            spark,
            name,
            partial(read_by_suffix, spark, path, name in by_record),
            root,
            as_of,
            normalisers=normalisers,
            staging=staging,
        )
        for name, path in datasets(spark, folder)
    ]
    log = spark.createDataFrame(lines, RUN_LOG).withColumn("executado_em", as_of.cast("timestamp"))
    log.write.mode("append").parquet(f"{root}/ingestoes")
    return log
