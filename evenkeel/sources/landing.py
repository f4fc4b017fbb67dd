"""Raw landing, file ledger, partition manifest and table sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import file_export_date
from evenkeel.sources.contracts import Contract, resolve
from evenkeel.sources.readers import csv_dialects, read_source


def property_records(prop: str = "property", listed: str = "properties") -> Column:
    """Logical records of a property document: points, incidents and nodes of the
    property, points and incidents of its children; of a document that lists
    ``properties`` instead (a directory of them), the listed ones."""
    p = F.col(prop)

    def points(readings: Column) -> Column:
        blocks = F.map_values(F.coalesce(readings, F.map_from_arrays(F.array(), F.array()).cast(
            "map<string,struct<data:array<struct<t:string,v:double,key:string,src:string>>>>")))
        return F.aggregate(blocks, F.lit(0), lambda n, b: n + F.coalesce(F.size(b["data"]), F.lit(0)))

    def length(c: Column) -> Column:
        return F.when(c.isNull(), 0).otherwise(F.size(c))

    children = F.when(p["children"].isNull(), 0).otherwise(F.aggregate(
        p["children"], F.lit(0), lambda n, c: n + points(c["readings"]) + length(c["incidents"])))
    own = points(p["readings"]) + length(p["incidents"]) + length(p["nodes"]) + children
    return F.when(p.isNull(), length(F.col(listed))).otherwise(own)


def file_ledger(rows: DataFrame, contract: Contract, ingest_date: str, schema_version: str = "0.1.0",
                records: Column | None = None) -> DataFrame:
    """One row a landed file, from the reader's own metadata.

    ``rows`` is any file-backed DataFrame; ``records`` is how many logical records
    a row stands for (one unless given).
    """
    count = F.count(F.lit(1)) if records is None else F.coalesce(F.sum(records), F.lit(0))
    meta = F.col("_metadata")
    # metadata columns are read beside whatever the counter needs
    grouped = rows.groupBy(
        meta["file_path"].alias("source_file"), meta["file_name"].alias("dest_file"),
        meta["file_size"].alias("byte_size"), meta["file_modification_time"].alias("_modified"),
    ).agg(count.cast("bigint").alias("row_count"))
    return grouped.select(
        F.lit(contract.source_system).alias("source_system"), F.lit(contract.name).alias("source_name"),
        F.lit(ingest_date).cast("date").alias("ingest_date"), "source_file", "dest_file",
        file_export_date("dest_file", "_modified").alias("export_date"), "byte_size", "row_count",
        F.lit(contract.format).alias("format"), F.lit(schema_version).alias("schema_version"),
        F.current_timestamp().alias("ingested_at"))


def source_records(spark: SparkSession, source: str, path: str) -> DataFrame:
    """(source_system, source_name, source_file, row_count): logical records of each file of
    a source family, counted as its format asks. A file without records has no row."""
    contract = resolve(source)
    if contract.format == "wide_csv":  # a record is a line; the reader unfolds it
        counted = csv_dialects(spark, path, contract.file_pattern).select(
            F.col("file_path").alias("source_file"), F.col("data_lines").alias("row_count"))
    else:
        one = property_records() if contract.format == "json_object" else F.lit(1)
        counted = read_source(spark, source, path).groupBy("source_file").agg(F.sum(one).cast("bigint").alias("row_count"))
    return counted.where("row_count > 0").select(F.lit(contract.source_system).alias("source_system"),
                          F.lit(contract.name).alias("source_name"), "source_file", "row_count")


def partition_manifest(ledger: DataFrame) -> DataFrame:
    """Files, bytes and rows per landed partition; rows are null if no file has a count.

    The per-file entries are the ledger itself.
    """
    return ledger.groupBy("source_system", "ingest_date").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("row_count").alias("total_row_count"),
        F.sum("byte_size").alias("total_bytes"))


def land_rows(raw: DataFrame, path: str, contract: Contract, ingest_date: str, schema_version: str = "0.1.0") -> None:
    """Append raw rows to the landing zone, one directory a source and date."""
    (
        raw.withColumns({
            "source_system": F.lit(contract.source_system), "ingest_date": F.lit(ingest_date).cast("date"),
            "schema_version": F.lit(schema_version), "ingested_at": F.current_timestamp(),
        })
        .write.mode("append").partitionBy("source_system", "ingest_date").parquet(path)
    )


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> str:
    """Overwrite a table. Rows are sorted inside each file, so readers that filter
    on the sort columns skip row groups; there is no global sort. Directories are
    filled by rebalanced tasks: few files for a small one, several for a hot one."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def publish(df: DataFrame, path: str, view: str, **kwargs) -> DataFrame:
    """Write a mart once and expose it as a view under its flat name."""
    spark = df.sparkSession
    write_table(df, path, **kwargs)
    table = spark.read.parquet(path)
    table.createOrReplaceTempView(view)
    return table


def quarantine(bad: DataFrame, path: str, layer: str, table: str, check: str, reason: str,
               run_id: str, limit: int | None = None) -> DataFrame:
    """Write failing rows (all, or ``limit`` as a sample) and return the meta row.

    The meta row counts every failing row, whatever is kept; they are worked out once,
    counted while they are written.
    """
    target = f"{path}/layer={layer}/table={table}/check={check}/run={run_id}"
    seen = Observation()
    counted = bad.observe(seen, F.count(F.lit(1)).alias("row_count"))
    if limit:  # every task hands on a few rows, so that all rows pass the counter
        place = F.monotonically_increasing_id() % (1 << 33)
        counted = counted.withColumn("_place", place).where(F.col("_place") < limit).drop("_place").repartition(1).limit(limit)
    counted.write.mode("overwrite").parquet(target)
    meta = bad.sparkSession.range(1).select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.lit(check).alias("check_id"),
        F.lit(reason).alias("reason"), F.lit(run_id).alias("run_id"), F.lit(seen.get["row_count"]).alias("row_count"),
        F.lit(target).alias("path"), F.current_timestamp().alias("quarantined_at"))
    meta.write.mode("append").json(f"{path}/meta")
    return meta


def write_report(results: DataFrame, path: str, ingest_date: str) -> None:
    """Check results as JSON lines, one folder a run date."""
    results.withColumn("ingest_date", F.lit(ingest_date)).write.mode("overwrite").json(f"{path}/ingest_date={ingest_date}")


def read_landed(spark: SparkSession, path: str, source_system: str, ingest_date: str) -> DataFrame:
    """One landed partition; both filters prune directories."""
    return spark.read.parquet(path).where(
        (F.col("source_system") == source_system) & (F.col("ingest_date") == F.lit(ingest_date).cast("date")))


def file_digests(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(source_file, dest_file, byte_size, sha256, content): files as they are, a file a row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.col("path").alias("source_file"), F.element_at(F.split("path", "/"), -1).alias("dest_file"),
                        F.col("length").alias("byte_size"), F.sha2("content", 256).alias("sha256"), "content")


def land_files(spark: SparkSession, source: str, target: str, contract: Contract, ingest_date: str) -> DataFrame:
    """Land files unchanged: names, sizes, digests and bytes, one directory a source and
    date. A file whose name and digest have landed before is not landed again, so a rerun
    adds nothing. Returns the rows of this run, without the bytes. A file is one row
    (files beyond 2 GB are read with ``land_rows``); Spark's scan passes over empty files,
    so they do not land."""
    found = file_digests(spark, source, contract.file_pattern)
    if _exists(spark, target):
        landed = spark.read.parquet(target).where(F.col("source_system") == contract.source_system)
        found = found.join(landed.select("dest_file", "sha256"), ["dest_file", "sha256"], "left_anti")
    run = uuid.uuid4().hex
    found.withColumns({
        "run": F.lit(run), "ingested_at": F.current_timestamp(), "source_system": F.lit(contract.source_system),
        "ingest_date": F.lit(ingest_date).cast("date"),
    }).write.mode("append").partitionBy("source_system", "ingest_date").parquet(target)
    if not _exists(spark, target):
        return found.drop("content").withColumn("ingest_date", F.lit(ingest_date).cast("date"))
    return spark.read.schema(found.withColumns({"run": F.lit(run), "source_system": F.lit(""), "ingest_date": F.lit(ingest_date).cast("date")}).schema).parquet(
        target).where(F.col("run") == run).drop("content", "run")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a table with files stands at ``path``."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place) and bool(
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path").take(1))
