"""From raw documents to packed training sequences, in stages."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import mixing, neardup, packing, quality, secrets
from evenkeel.llm.common import carried, drop_folders, given_back, new_path, table, tables_made
from evenkeel.session import pin_utc


def _named(docs: DataFrame) -> list:
    """All columns, whatever their names hold."""
    return [F.col(f"`{c}`") for c in docs.columns]


def _documents(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of documents; ``n_chars`` follows the text."""
    if "n_chars" in like.columns:
        kind = like.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))
    return rows.select(*_named(like))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Where a stage's result says, in its schema (so in its Parquet files too), which
#: tables in the shared folder it is read from.
READS = "read_from"


def stage(fn: Stage) -> Stage:
    """A stage's result is written before the next stage is called with what was written,
    so that one first deletes the tables which exactly this result was read from. A frame
    that still reads them (it was not written) keeps them."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        done = docs.schema[0].metadata.get(READS, [])
        if done and not any(folder in file for folder in done for file in docs.inputFiles()):
            drop_folders(spark, done)
        with tables_made() as made:
            out = fn(spark, docs, sf_dir)
        first, *rest = out.columns
        facts = {k: v for k, v in out.schema[0].metadata.items() if k != READS}
        return out.select(F.col(f"`{first}`").alias(first, metadata={**facts, READS: made}), *[F.col(f"`{c}`") for c in rest])

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, unchanged; texts of unknown words go, however rare."""
    return quality.quality_rules(docs, least_known=quality.LEAST_KNOWN).where("quality.kept").select(*_named(docs))


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8), the one
    with the smallest id; repeated rows once. Texts without a word all stay. An id may
    have several texts, or be null: each row is kept or not by its own text. Columns of
    any name are carried along; no documents, no rows."""
    mark = F.xxhash64("text")
    kept = neardup.near_duplicates(docs.select("doc_id", "text", mark.alias("mark_of_text")), mark="mark_of_text").where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("mark").alias("kept_mark")).distinct()
    rows = docs.select(*carried(docs.columns), F.col("doc_id").alias("own_id"), mark.alias("own_mark"))
    mine = F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_mark") == F.col("kept_mark"))
    text = f"__kept_{docs.columns.index('text')}"
    return rows.join(kept, mine, "left_semi").dropDuplicates(["own_id", text]).select(*given_back(docs.columns))


@stage
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kinds. Null texts stay null or become empty;
    repeated rows stay; no documents, no rows."""
    return _documents(secrets.scan_secrets(docs, redact=True), docs)


@stage
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a source's last one as far as its target.
    Texts without a word are never taken; equal rows count each; no documents, no rows."""
    return _documents(mixing.mixed_documents(mixing.mix_sources(docs)), docs)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens. A null or empty text is
    its end id alone; repeated rows are packed each; no documents, no rows."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("MinHash near-dedup", near_dedup), ("secret scans", secret_scan),
          ("mixing sources", source_mixing), ("packing", packed)]

#: Sketches, checksums and tokens are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    docs = table(pin_utc(spark), sf_dir, "documents")
    for name, step in STAGES:
        path = new_path(spark, f"stage-{name.replace(' ', '-')}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
