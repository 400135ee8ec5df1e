"""Readers for landed files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from canteiro.functions.markup import unescape
from canteiro.functions.text import WHITESPACE, slug_name
from canteiro.operators.dedup import SOURCE_POSITION, with_source_position
from canteiro.operators.merge import list_names
from canteiro.operators.records import as_columns, parsed_records

CORRUPT = "_corrupt_record"


def read_records(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Records of JSON files as VARIANT values in source order, and the unreadable ones; no pass looks for a schema.

    A file is a list of records, one record, or an envelope whose ``dados`` holds the list; such
    a file is read by one task. ``lines`` reads one record per line, which Spark can split;
    prefer it for large inputs.
    """
    rows, rejects = parsed_records(_record_texts(spark, path, lines), "value")
    return rows, rejects.select(F.col("value").alias(CORRUPT), "_file")


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType | None = None, lines: bool = False
) -> tuple[DataFrame, DataFrame]:
    """As ``read_records``, with the records' keys as columns.

    Without a schema one aggregate finds the keys of all records; keys that differ only in case
    are one column, and each record gives the value that it has.
    """
    if schema is None:
        rows, rejects = read_records(spark, path, lines)
        return as_columns(rows), rejects
    rows, rejects = json_rows(_record_texts(spark, path, lines), "value", schema)
    return rows, rejects.select(F.col("value").alias(CORRUPT), "_file")


def _record_texts(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    """The text (value) of each record of JSON files, with its place."""
    texts = with_source_position(spark.read.option("wholetext", not lines).text(path))
    if lines:
        items = texts.where(F.trim("value") != "").withColumn("_item", F.lit(0))
    else:
        trimmed = F.btrim("value", F.lit(WHITESPACE + "\ufeff"))
        enveloped = F.try_element_at(F.from_json("value", "map<string,string>"), F.lit("dados"))
        single = F.concat(F.lit("["), trimmed, F.lit("]"))
        listed = (
            F.when(trimmed.startswith("["), trimmed)
            .when(F.trim(enveloped).startswith("["), enveloped)
            .otherwise(single)
        )
        parsed = texts.withColumn("__items", F.from_json(listed, "array<string>"))
        exploded = parsed.where(F.col("__items").isNull() | (F.size("__items") > 0)).select(
            *SOURCE_POSITION, "value", F.posexplode_outer("__items").alias("_item", "__text")
        )
        # a file that is no JSON at all is one unreadable record
        items = exploded.withColumn("value", F.when(F.col("_item").isNotNull(), F.col("__text")).otherwise(F.col("value")))
    return items.select("value", *SOURCE_POSITION, F.coalesce("_item", F.lit(0)).alias("_item"))


def json_rows(texts: DataFrame, text: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Records of a column of JSON texts as columns, and the rows whose text is no record.

    The other columns are kept in both; a NULL text is in neither.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = texts.withColumn("__record", F.from_json(text, with_corrupt, options))
    corrupt = F.col(f"__record.{CORRUPT}").isNotNull()
    others = [F.col(f"`{name}`") for name in texts.columns if name != text]
    rows = parsed.where(F.col("__record").isNotNull() & ~corrupt)
    cells = [F.col("__record").getField(name).alias(name) for name in schema.names]
    return rows.select(*cells, *others), parsed.where(corrupt).drop("__record")


def csv_cells(record: Column | str, separator: str) -> Column:
    """Cells of one CSV record as texts: quotes removed, doubled quotes single.

    The pattern is possessive, so a record of any length is read in one pass.
    """
    record = F.col(record) if isinstance(record, str) else record
    mark = re.escape(separator)
    # a cell starts with a quote or not, and may hold text after its closing quote
    cell = rf'((?:"(?:[^"]++|"")*+")?+[^{mark}]*+){mark}'
    found = F.regexp_extract_all(F.concat(record, F.lit(separator)), F.lit(cell), F.lit(1))
    quoted = r'(?s)^"(.*)"([^"]*)$'

    def text(cell: Column) -> Column:
        inner = F.regexp_replace(cell, quoted, "$1$2")
        return F.when(cell.rlike(quoted), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(cell)

    return F.transform(found, text)


def with_cells(rows: DataFrame, cells: str, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of cells under column names, and the rows with too many cells.

    A short row is padded with NULLs. An empty cell is NULL. Both results hold the same rows
    whichever of their columns are read.
    """
    width = len(names)
    fits = F.size(cells) <= width
    kept = rows.where(fits).select(
        *[F.nullif(F.get(cells, F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(names)],
        *[c for c in rows.columns if c != cells],
    )
    return kept, rows.where(~fits)


@dataclass(frozen=True)
class _Scan:
    """What one pass over delimited text tells: the first line that is not blank, whether all text is UTF-8, and for
    each separator whether a quoted cell goes on after its line."""

    header: str | None
    utf8: bool
    opens: dict[str, bool]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as they are in the file, in source order; a file is split among tasks."""
    lines = with_source_position(spark.read.option("lineSep", "\n").text(path))
    # the text may not be UTF-8, so no pattern touches it here
    marked = (F.col("_block") == 0) & F.col("value").startswith("\ufeff")
    return lines.withColumn("value", F.when(marked, F.substring("value", 2, 2**31 - 1)).otherwise(F.col("value")))


def _scan(lines: DataFrame, separators: Sequence[str]) -> _Scan:
    filled = F.btrim("value", F.lit(WHITESPACE)) != ""
    first = F.min_by("value", F.when(filled, F.struct(*SOURCE_POSITION)))
    opens = [F.max(F.col("value").contains('"') & F.col("value").rlike(open_after(s, False))).alias(f"o{i}") for i, s in enumerate(separators)]
    row = lines.agg(first.alias("header"), F.bool_and(F.is_valid_utf8("value")).alias("utf8"), *opens).first()
    flags = {s: bool(row[f"o{i}"]) for i, s in enumerate(separators)}
    return _Scan(row["header"], row["utf8"] is not False, flags)


def open_after(separator: str, inside: bool) -> str:
    """Pattern of a line after which a quoted cell is open, for a line that starts inside of one or not.

    A quote opens a cell at its start only; a carriage return ends a record, so a cell starts after it.
    """
    mark = re.escape(separator)
    quoted, rest = r'(?:[^"]++|"")*+', rf"[^{mark}\r]*+"
    cells = rf'(?:(?:"{quoted}"{rest}|(?!"){rest})[{mark}\r])*+'
    opened = rf'{cells}"{quoted}\z'
    return rf'^{quoted}(?:\z|"{rest}[{mark}\r]{opened})' if inside else f"^{opened}"


def _joined_lines(lines: DataFrame, separator: str) -> DataFrame:
    """Lines as records: a line inside quotes belongs to the record that was open before it.

    What a line does to the state (inside quotes or not) is one of four functions: it leaves it, turns it, or sets it
    either way. Functions are composed within each block of a file, then over the blocks, of which there are few; so
    each block's task knows the state that it starts with. A quote that is never closed is plain text.
    """
    from_out, from_in = F.col("value").rlike(open_after(separator, False)), F.col("value").rlike(open_after(separator, True))
    inside = Window.partitionBy("_file", "_block").orderBy("_row")
    blocks = Window.partitionBy("_file").orderBy("_block")
    upto, before = (Window.unboundedPreceding, Window.currentRow), (Window.unboundedPreceding, -1)

    def composed(frame: DataFrame, over: WindowSpec) -> DataFrame:
        """``turned`` and ``value`` of the functions before a row: the state is the last one set, turned so often since."""
        turns = frame.withColumn("__turns", F.sum("__turn").over(over.rowsBetween(*upto)))
        fixed = F.when(F.col("__set").isNotNull(), (F.col("__set") + F.col("__turns")) % 2)
        return turns.withColumns(
            {
                "__turned": F.coalesce(F.sum("__turn").over(over.rowsBetween(*before)), F.lit(0)),
                "__fixed": F.last(fixed, ignorenulls=True).over(over.rowsBetween(*before)),
                "__fixed_after": F.last(fixed, ignorenulls=True).over(over.rowsBetween(*upto)),
            }
        )

    turn = F.when(from_out & ~from_in, 1).otherwise(0)
    fixed_to = F.when(from_out & from_in, 1).when(~from_out & ~from_in, 0)
    states = composed(lines.withColumns({"__turn": turn, "__set": fixed_to}), inside)
    ends = states.groupBy("_file", "_block").agg(F.max_by(F.struct("__turns", "__fixed_after"), "_row").alias("e"))
    sums = ends.select(
        "_file",
        "_block",
        F.when(F.col("e.__fixed_after").isNull(), F.col("e.__turns") % 2).otherwise(0).alias("__turn"),
        ((F.col("e.__fixed_after") + F.col("e.__turns")) % 2).alias("__set"),
    )
    starts = composed(sums, blocks).select(
        "_file", "_block", ((F.coalesce("__fixed", F.lit(0)) + F.col("__turned")) % 2).alias("__start")
    )
    known = states.join(starts, ["_file", "_block"])
    state = (F.coalesce("__fixed", "__start") + F.col("__turned")) % 2
    after = (F.coalesce("__fixed_after", "__start") + F.col("__turns")) % 2
    place = F.struct("_block", "_row")
    marked = known.select("value", *SOURCE_POSITION, (state == 0).alias("__first"), (after == 1).alias("__open"))

    # the last record that starts in each block, the last line with a quote that stands alone, and the state at the end
    paired = F.col("value").rlike(r'^(?:[^"]++|"")*+\z')
    heads = marked.groupBy("_file", "_block").agg(
        F.max(F.when(F.col("__first"), place)).alias("head"),
        F.max(F.when(~paired, place)).alias("quote"),
        F.max_by("__open", "_row").alias("open"),
    )
    whole = blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = heads.select(
        "_file",
        "_block",
        F.last("head", ignorenulls=True).over(blocks.rowsBetween(*before)).alias("__carried"),
        F.last("quote", ignorenulls=True).over(whole).alias("__quote"),
        F.last("open").over(whole).alias("__never"),
    )
    rows = marked.join(carried, ["_file", "_block"])
    # after a quote that is never closed, every line is a record
    plain = F.col("__never") & (place > F.col("__quote"))
    single = plain | (F.col("__first") & ~F.col("__open"))
    head = F.coalesce(F.last(F.when(F.col("__first"), place), ignorenulls=True).over(inside.rowsBetween(*upto)), F.col("__carried"))
    told = rows.withColumns({"__single": single, "__head": head})
    alone = told.where("__single").select("value", *SOURCE_POSITION)
    several = (
        told.where("NOT __single")
        .groupBy("_file", "__head")
        .agg(F.sort_array(F.collect_list(F.struct("_block", "_row", "value"))).alias("parts"))
        .select(F.array_join("parts.value", "\n").alias("value"), "_file", "__head._block", "__head._row")
    )
    return alone.unionByName(several)


def _records(lines: DataFrame, separator: str, opens: bool) -> DataFrame:
    """Records of delimited text with their place, blank ones left out; a line break inside quotes does not end one."""
    whole = _joined_lines(lines, separator) if opens else lines
    mark = re.escape(separator)
    # a carriage return ends a record as well
    record = rf'(?:(?:"(?:[^"]++|"")*+")?+[^{mark}\r\n]*+(?:{mark}|(?=[\r\n]|\z)))++'
    parts = F.when(F.col("value").contains("\r"), F.regexp_extract_all("value", F.lit(record), F.lit(0))).otherwise(F.array("value"))
    filled = F.filter(parts, lambda text: F.btrim(text, F.lit(WHITESPACE)) != "")
    return whole.select(*SOURCE_POSITION, F.posexplode(filled).alias("_item", CORRUPT))


def read_csv_records(
    spark: SparkSession, path: str, separator: str = ",", encoding: str = "UTF-8"
) -> tuple[DataFrame, DataFrame]:
    """CSV with a header, every cell as text in source order, and the records with too many cells.

    Short records are padded; a quoted cell may hold separators and line breaks. A file is read by
    as many tasks as it has blocks.
    """
    lines = _lines(spark, path)
    if encoding != "UTF-8":
        lines = lines.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))
    return _csv_rows(lines, separator, _scan(lines, [separator]))


def _csv_rows(lines: DataFrame, separator: str, scan: _Scan) -> tuple[DataFrame, DataFrame]:
    spark = lines.sparkSession
    records = _records(lines, separator, scan.opens[separator])
    if scan.header is None:
        nothing = records.where(F.lit(False))
        return spark.createDataFrame([], "_file string, _block long, _row long, _item int"), nothing.select(CORRUPT, "_file")
    place = F.struct("_block", "_row", "_item")
    tops = records.groupBy("_file").agg(F.min(F.struct(place.alias("place"), CORRUPT)).alias("top"))
    header = scan.header
    if scan.opens[separator] or "\r" in header:
        # the header may go on after its line, or end within it
        header = tops.orderBy("_file").first()["top"][CORRUPT]
    names = _unique_names(spark.range(1).select(csv_cells(F.lit(header), separator)).first()[0])
    # every file has its own header
    body = records.join(tops.select("_file", "top.place"), "_file").where(place != F.col("place")).drop("place")
    rows, rejects = with_cells(body.withColumn("__cells", csv_cells(CORRUPT, separator)), "__cells", names)
    return rows.select(*[F.col(f"`{n}`") for n in names], *SOURCE_POSITION, "_item"), rejects.select(CORRUPT, "_file")


def _unique_names(cells: Sequence[str]) -> list[str]:
    """Header cells as column names; a name that repeats, in any case, gets its place behind it."""
    lowered = [cell.strip().lower() for cell in cells]
    return [
        (cell.strip() or "_c") + (str(place) if lowered.count(lowered[place]) > 1 or not cell.strip() else "")
        for place, cell in enumerate(cells)
    ]


def _windows_1252_table() -> tuple[str, str]:
    """Control characters that Windows uses for print characters, derived from the codec."""
    source, target = "", ""
    for code in range(0x80, 0xA0):
        try:
            target += bytes([code]).decode("cp1252")
            source += chr(code)
        except UnicodeDecodeError:
            continue
    return source, target


def read_delimited(
    spark: SparkSession, path: str, separators: Sequence[str] = (";", ",", "\t")
) -> tuple[DataFrame, DataFrame]:
    """Delimited text of unknown encoding and separator, and the records with too many cells.

    UTF-8 when all lines are, else Windows-1252. The first separator that cuts the header into at
    least two columns wins. One pass finds both, and whether cells go on after their line.
    """
    lines = _lines(spark, path)
    scan = _scan(lines, separators)
    if not scan.utf8:
        # a byte is a character; those that only Windows prints are translated
        source, target = _windows_1252_table()
        text = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
        lines = lines.withColumn("value", F.translate(text, source, target))
        scan = replace(scan, header=lines.where(F.btrim("value", F.lit(WHITESPACE)) != "").orderBy(*SOURCE_POSITION).first()["value"])
    for separator in separators:
        if scan.header is not None and separator in re.sub(r'"(?:[^"]|"")*"', "", scan.header):
            return _csv_rows(lines, separator, scan)
    raise ValueError(f"no separator gives a table for {path}")


def read_dump(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """National dump: ``;``-separated UTF-8, and the records with too many cells."""
    return read_csv_records(spark, path, ";")


def read_by_suffix(spark: SparkSession, path: str, as_records: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows and unreadable records (``_corrupt_record``, ``_file``), by the reader for the suffix.

    ``as_records`` keeps JSON records as they are, for a normaliser that looks up their fields.
    """
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix in ("json", "jsonl"):
        read = read_records if as_records else read_json_records
        return read(spark, path, lines=suffix == "jsonl")
    if suffix == "csv":
        return read_delimited(spark, path)
    nothing = spark.createDataFrame([], f"{CORRUPT} string, _file string")
    if suffix == "parquet":
        return spark.read.parquet(path), nothing
    if suffix in ("kml", "xml"):
        return read_placemarks(spark, path), nothing
    raise ValueError(f"no reader for .{suffix}")


def read_placemarks(spark: SparkSession, path: str) -> DataFrame:
    """Placemarks of map layers at every level: each under the folder that holds it directly.

    Folders nest, and a row tag stops at the outermost one. The rows of a folder are therefore read
    from the text of the file: a placemark belongs to the folder or document that was opened last
    and is still open. A map is one file of one task.
    """
    whole = spark.read.format("binaryFile").load(path).select(F.decode("content", "UTF-8").alias("text"))
    return placemarks_in(whole, "text")


def placemarks_in(maps: DataFrame, text: str) -> DataFrame:
    """Placemarks of map texts, one row each, with the name of their layer."""
    token = (
        r"(?s)<(?:\w+:)?(?:Folder|Document)\b[^>]*+>(?:\s*+<(?:\w+:)?name\b[^>]*+>.*?</(?:\w+:)?name>)?"
        r"|</(?:\w+:)?(?:Folder|Document)>|<(?:\w+:)?Placemark\b.*?</(?:\w+:)?Placemark>"
    )
    # marks as rows: the depth after each is a running sum, and a placemark belongs to the folder that was
    # opened last at its depth; a map's own order is all that is sorted
    tokens = maps.select(
        F.monotonically_increasing_id().alias("map"), F.regexp_extract_all(text, F.lit(token), F.lit(0)).alias("tokens")
    )
    parts = tokens.select("map", F.posexplode("tokens").alias("k", "mark"))
    is_placemark = F.col("mark").rlike(r"^<(?:\w+:)?Placemark")
    step = F.when(is_placemark, 0).when(F.col("mark").startswith("</"), -1).otherwise(1)
    running = Window.partitionBy("map").orderBy("k")
    sums = parts.withColumn("step", step).withColumn("sum", F.sum("step").over(running))
    # a folder closed too often closes nothing
    depths = sums.withColumn("depth", F.col("sum") - F.least(F.lit(0), F.min("sum").over(running)))
    level = Window.partitionBy("map", "depth").orderBy("k")
    layer = F.last(F.when(F.col("step") == 1, F.coalesce(_element(F.col("mark"), "name"), F.lit(""))), ignorenulls=True).over(level)
    marks = depths.withColumn("layer", layer).where((F.col("step") == 0) & (F.col("depth") > 0)).select(F.struct("layer", "mark").alias("f"))
    schema = (
        "name string, description string, styleUrl string, Style struct<IconStyle: struct<Icon: struct<href: string>>>, "
        "Point struct<coordinates: string>, MultiGeometry struct<Point: struct<coordinates: string>>"
    )
    plain = F.regexp_replace("f.mark", r"<(/?)\w+:(\w)", "<$1$2")
    return (
        marks.select(
            F.coalesce(F.nullif(F.trim("f.layer"), F.lit("")), F.lit("sem_camada")).alias("camada"),
            F.from_xml(plain, schema).alias("p"),
        )
        .select(
            F.coalesce(F.trim("p.name"), F.lit("")).alias("nome"),
            "camada",
            F.coalesce(F.trim("p.description"), F.lit("")).alias("descricao_raw"),
            F.coalesce("p.Style.IconStyle.Icon.href", "p.styleUrl").alias("icone"),
            F.trim(F.coalesce("p.Point.coordinates", "p.MultiGeometry.Point.coordinates")).alias("coords_kml"),
        )
    )


def _element(text: Column, name: str) -> Column:
    """Text of the first element of a name; NULL without one."""
    found = F.regexp_extract(text, rf"(?s)<(?:\w+:)?{name}\b[^>]*+>\s*+(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</(?:\w+:)?{name}>", 1)
    return F.nullif(unescape(F.trim(found)), F.lit(""))


def matrix_records(df: DataFrame, header: Sequence[str], rows: str = "rows") -> DataFrame:
    """Rows of text cells under a header, as columns with slug names; short rows give NULLs."""
    # the outer form keeps Spark from computing the matrix once more for a filter
    cells = df.select(F.explode_outer(rows).alias("cells")).where(F.col("cells").isNotNull())
    return cells.select(*[F.get("cells", F.lit(i)).alias(slug_name(name)) for i, name in enumerate(header)])


def datasets(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(name, path) of the landed datasets: JSON, then CSV, then maps, each sorted by name."""
    names = list_names(spark, folder)
    found = []
    for suffix in (".json", ".jsonl", ".csv", ".kml", ".xml"):
        found += [(n[: -len(suffix)], f"{folder.rstrip('/')}/{n}") for n in names if n.endswith(suffix)]
    return found
