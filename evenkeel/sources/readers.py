"""Readers for raw exports: CSV dialects, nested JSON, wide CSV, Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import NULL_LITERALS, cp1252_from_latin1, delimiter_of
from evenkeel.sources.contracts import OCCUPANCY_SCHEMA, PROPERTY_SCHEMA, resolve
from evenkeel.sources.records import cells_of, csv_records, split_states

SIDE_FILES = r"(\.meta\.json|^_manifest\.json)$"


def _lines(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    """Every line of every file, up to its line feed. The text source copies bytes without
    decoding them (but for a byte-order mark, which it drops), so lines may be invalid UTF-8."""
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_at"))


def _text(value: str, utf8: Column, latin1: bool = False) -> Column:
    """Characters of a line: UTF-8 or one byte each, Windows-1252 unless ``latin1``."""
    single = F.decode(F.col(value).cast("binary"), "ISO-8859-1")
    return F.when(utf8, F.col(value)).otherwise(single if latin1 else cp1252_from_latin1(single))


def _decoded(value: str, utf8: Column, latin1: bool = False) -> Column:
    """A line without byte-order mark and carriage return around it."""
    return F.regexp_replace(F.ltrim(_text(value, utf8, latin1), F.lit("\ufeff")), "\r\\z", "")


def csv_dialects(spark: SparkSession, path: str, glob: str | None = "*.csv") -> DataFrame:
    """One row a file: encoding, delimiter, header and data lines, from one scan.

    UTF-8 if every line is valid UTF-8 (a byte-order mark is dropped on reading),
    else Windows-1252.
    """
    per_file = _lines(spark, path, glob).groupBy("file_path", "file_name").agg(
        F.min_by("value", "_at").alias("_header"), F.bool_and(F.is_valid_utf8("value")).alias("_utf8"),
        (F.count(F.lit(1)) - 1).alias("data_lines"))
    header = _decoded("_header", F.col("_utf8"))
    return per_file.select(
        "file_path", "file_name", F.when(F.col("_utf8"), "utf-8").otherwise("cp1252").alias("encoding"),
        header.alias("header"), delimiter_of(header).alias("delimiter"), "data_lines")


def read_erp_csv(spark: SparkSession, path: str, glob: str | None = "*.csv", encoding: str | None = None,
                 delimiter: str | None = None, columns: Sequence[str] | None = None,
                 null_literals: Sequence[str] = NULL_LITERALS) -> DataFrame:
    """All files of an export as string columns plus ``source_file``.

    One plan for any number of files, dialects and headers, and a large file is read by
    many tasks (``records``): a split's dialect and starting state stand beside its
    lines, and a column is taken from wherever the file's own header has it (null where
    it does not). ``columns`` names the columns (a contract's, say) and makes reading
    them the first job; otherwise the distinct headers are looked up before. Empty
    lines outside quotes are dropped; a file's first record is its header. ``encoding``
    is ``utf-8``, ``cp1252`` or ``iso-8859-1``; without it each file's is looked for. Cells
    of UTF-8 files that are one of ``null_literals`` are null, as a cell left empty is anywhere.
    """
    lines = _lines(spark, path, glob).select(
        "file_path", F.col("_at.file_block_start").alias("block"), F.col("_at.col2").alias("at"), "value")
    states = split_states(lines)
    utf8, latin1 = F.lit(encoding == "utf-8") if encoding else F.col("utf8"), encoding == "iso-8859-1"
    header = _decoded("header_line", utf8, latin1)
    sep = F.lit(delimiter) if delimiter else delimiter_of(header)
    heads = states.select("file_path", "block", "inside", "first_block", utf8.alias("utf8"), sep.alias("sep"),
                          F.transform(cells_of(header, sep), lambda h: F.btrim(h)).alias("names"))
    if columns is None:
        found = heads.select(F.posexplode("names").alias("place", "name")).groupBy("name").agg(F.min("place").alias("place"))
        columns = [r["name"] for r in found.where("name IS NOT NULL").orderBy("place", "name").collect()]
        if not columns:
            raise FileNotFoundError(f"no files match {glob!r} under {path}")
    heads = heads.withColumn("places", F.transform(F.lit(list(columns)), lambda n: F.array_position("names", n).cast("int")))
    dialects = heads.select("file_path", "block", "utf8", "sep", "places", "first_block")
    decoded = lines.join(heads.select("file_path", "block", "utf8"), ["file_path", "block"]).select(
        "file_path", "block", "at", _text("value", F.col("utf8"), latin1).alias("value"))
    records = csv_records(decoded, heads).where(F.col("text") != "").join(dialects, ["file_path", "block"])
    data = records.where((F.col("block") != F.col("first_block")) | (F.col("seq") != 0))
    cut = data.select("file_path", "utf8", "places", cells_of(F.col("text"), F.col("sep")).alias("cells"))
    cell = lambda i: F.get("cells", F.get("places", F.lit(i)) - 1)
    value = lambda i: F.when(~(F.col("utf8") & F.coalesce(cell(i).isin(*null_literals), F.lit(False))), cell(i)) if null_literals else cell(i)
    return cut.select(*[value(i).alias(n) for i, n in enumerate(columns)], F.col("file_path").alias("source_file"))


def read_properties(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """One row a building-automation document.

    A document is one task; ``conform.explode_readings(spread=…)`` deals its
    metrics out, and its long table is what later stages read.
    """
    return (
        spark.read.schema(PROPERTY_SCHEMA).option("multiLine", "true").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob).json(path)
        .select("property", "properties", F.col("_metadata.file_path").alias("source_file"),
                F.col("_metadata.file_name").alias("file_name"))
        .where(~F.col("file_name").rlike(SIDE_FILES))
    )


POINTS = "array<struct<t: string, v: double, key: string, src: string>>"


def read_property_metrics(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """One row a metric of a building-automation document, of the property or a child:
    property_id, parent_property_id, metric, data (its points), issue, source_file.

    A file is one document, or one a line if its first line is one. A document is parsed once, into a variant; its metrics leave
    that task as rows and are dealt out before their points are unfolded. A document that
    is empty or does not parse is one row that says so in ``issue``.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    docs = files.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("source_file"))
    docs = docs.where(~F.element_at(F.split("source_file", "/"), -1).rlike(SIDE_FILES))
    by_line = F.try_parse_json(F.substring_index("value", "\n", 1)).isNotNull()
    texts = F.when(by_line, F.filter(F.split("value", "\n"), lambda line: F.trim(line) != "")).otherwise(F.array("value"))
    every = docs.select("source_file", F.explode(texts).alias("value")).withColumn("doc", F.try_parse_json("value"))
    prop = F.try_variant_get("doc", "$.property", "variant")
    issue = F.when(F.trim("value") == "", "empty document").when(F.col("doc").isNull(), "broken document").when(
        F.try_variant_get(prop, "$.id", "string").isNull(), "no property id")
    named = every.select("source_file", prop.alias("property"), issue.alias("issue"))
    broken = named.where("issue IS NOT NULL").select(
        *[F.lit(None).cast("string").alias(c) for c in ("property_id", "parent_property_id", "metric")],
        F.lit(None).cast(POINTS).alias("data"), "issue", "source_file")
    good = named.where("issue IS NULL")
    own = F.try_variant_get("property", "$.id", "string")
    children = F.transform(F.coalesce(F.try_variant_get("property", "$.children", "array<variant>"), F.array()),
                           lambda c: F.struct(c.alias("member"), own.alias("parent")))
    members = good.select("source_file", F.explode(F.concat(F.array(F.struct(
        F.col("property").alias("member"), F.lit(None).cast("string").alias("parent"))), children)).alias("m"))
    readings = F.try_variant_get("m.member", "$.readings", "map<string, variant>")
    metrics = members.select(
        "source_file", F.try_variant_get("m.member", "$.id", "string").alias("property_id"), F.col("m.parent").alias("parent_property_id"),
        F.explode(readings).alias("metric", "block"))
    dealt = metrics.hint("rebalance", "property_id", "metric")
    return dealt.select("property_id", "parent_property_id", "metric", F.try_variant_get("block", "$.data", POINTS).alias("data"),
                        F.lit(None).cast("string").alias("issue"), "source_file").unionByName(broken)


def read_occupancy(spark: SparkSession, path: str, glob: str = "*.json", strict: bool = True) -> DataFrame:
    """One row a floor and weekday profile; a wrong number of hours raises if ``strict``."""
    rows = (
        spark.read.schema(OCCUPANCY_SCHEMA).option("multiLine", "true").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob).json(path)
        .select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_name").alias("file_name"))
        .where(~F.col("file_name").rlike(SIDE_FILES))
    )
    if not strict:
        return rows
    hours = F.coalesce(F.size("occupancy"), F.lit(0))
    message = F.concat(F.lit("expected 24 hourly values in "), F.col("file_name"), F.lit(", got "), hours.cast("string"))
    return rows.withColumn("occupancy", F.when(hours == 24, F.col("occupancy")).otherwise(
        F.raise_error(message).cast("array<double>")))


def read_wide_csv(spark: SparkSession, path: str, identifier: str = "asset",
                  glob: str = "Room_Utilization_*.csv") -> DataFrame:
    """Long (identifier, header, value) rows of wide files with unlike headers.

    Each line meets its own file's header as an array, so files with different
    date columns need neither a common schema nor a read per file.
    """
    heads = csv_dialects(spark, path, glob).select(
        F.col("file_path").alias("_path"), F.col("header").alias("_head"), "delimiter", "encoding")
    lines = _lines(spark, path, glob).join(heads, F.col("file_path") == F.col("_path"))
    text = _decoded("value", F.col("encoding") == "utf-8")

    def cells(c: Column) -> Column:
        # a separator inside double quotes does not separate
        outside = '(?=(?:[^"]*"[^"]*")*[^"]*$)'
        parts = F.when(F.col("delimiter") == ";", F.split(c, ";" + outside)).otherwise(F.split(c, "," + outside))
        return F.transform(parts, lambda p: F.btrim(p, F.lit(' "')))

    rows = lines.withColumn("_text", text).where((F.col("_text") != F.col("_head")) & (F.col("_text") != ""))
    rows = rows.select("file_path", "file_name", cells(F.col("_head")).alias("_h"), cells(F.col("_text")).alias("_c"))
    at = F.array_position("_h", identifier).cast("int")
    named = F.when(at > 0, F.get("_c", at - 1)).otherwise(
        F.raise_error(F.concat(F.lit(f"expected column {identifier} in "), F.col("file_name"))).cast("string"))
    long = rows.select("file_path", "file_name", named.alias(identifier), F.inline(F.arrays_zip(
        F.col("_h").alias("header"), F.col("_c").alias("value"))))
    return long.where(F.col("header") != identifier)


def read_source(spark: SparkSession, source: str, path: str) -> DataFrame:
    """The raw rows of a source family, by its name or alias, as its contract says they
    are delivered; each row names its ``source_file``."""
    contract = resolve(source)
    if contract.format == "csv":
        return read_erp_csv(spark, path, contract.file_pattern, columns=contract.columns)
    if contract.format == "json_object":
        return read_properties(spark, path, contract.file_pattern)
    if contract.format == "json_array":
        return read_occupancy(spark, path, contract.file_pattern)
    if contract.format == "wide_csv":
        return read_wide_csv(spark, path, glob=contract.file_pattern).withColumnRenamed("file_path", "source_file")
    raise ValueError(f"no reader for {contract.format!r}, the format of {contract.name}")


def read_table(spark: SparkSession, path: str, site: str | None = None, site_column: str = "site_id") -> DataFrame:
    """A Parquet table; the site filter reaches the scan. Sorting is the sink's business."""
    table = spark.read.parquet(path)
    return table.where(F.col(site_column) == site) if site is not None else table


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table; no column is read, so a Parquet scan only visits footers."""
    parts = [t.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n, t in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables available to ``spark.sql``."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
