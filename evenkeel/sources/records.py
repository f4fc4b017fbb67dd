"""CSV records of splittable files: every split knows whether it starts inside quotes.

A quoted cell may hold line breaks, so where a record ends depends on all quotes
before it. Each split counts its quotes; the counts of the splits before it, one row a
split, tell the state at its start; then every task cuts its own lines into records in
their order. What crosses a border leaves as fragments, at most two a split, which are
joined afterwards. Quotes follow RFC 4180: a cell that holds one is quoted and the
quote doubled. A record ends with a line feed outside quotes, and a carriage return
before that; within quotes both are text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# executors need not have this package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Stands for a separator outside quotes while a record is cut into cells.
MARK = "\x01"
#: Begins what stands for a mark, or for itself, in a text that holds either.
ESCAPE = "\x02"
RECORDS = "file_path string, block bigint, seq bigint, text string, opens boolean, closes boolean"


def quotes_in(value: Column) -> Column:
    """Number of double quotes, counted in bytes, so that the text may be invalid UTF-8."""
    return F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))


def split_states(lines: DataFrame) -> DataFrame:
    """One row a split (file_path, block): its first line, whether it is valid UTF-8,
    and whether it starts inside quotes. ``lines`` has file_path, block, at, value."""
    counted = lines.groupBy("file_path", "block").agg(
        F.min_by("value", "at").alias("first_line"), F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.sum(quotes_in(F.col("value"))).alias("quotes"))
    earlier = W.partitionBy("file_path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("file_path")
    return counted.select(
        "file_path", "block", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1).alias("inside"),
        F.bool_and("utf8").over(whole).alias("utf8"),
        F.min_by("first_line", "block").over(whole).alias("header_line"), F.min("block").over(whole).alias("first_block"))


def _cut_records(batches: Iterator) -> Iterator:
    """Lines in the order of their splits → records and fragments."""
    import pyarrow as pa
    import pyarrow.compute as pc

    split, seq, inside, open_text, fresh = None, 0, False, None, True
    names = [c.split()[0] for c in RECORDS.split(", ")]
    rows: list[tuple] = []

    def leave():
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
        rows.clear()
        return batch

    def end_split():
        nonlocal open_text
        if open_text is not None:  # goes on in the next split
            rows.append((*split, seq, "\n".join(open_text), not fresh, False))
        open_text = None

    for batch in batches:
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        odd = (pc.count_substring(column("value"), '"').to_numpy() % 2).astype(bool)
        keys = zip(column("file_path").to_pylist(), column("block").to_pylist())
        for key, starts, value, turns in zip(keys, column("inside").to_pylist(), column("value").to_pylist(), odd.tolist()):
            if key != split:
                if split is not None:
                    end_split()
                split, seq, inside = key, 0, starts
                open_text, fresh = ([], True) if starts else (None, False)
            if inside:
                open_text.append(value)
            else:
                open_text = [value]
            inside ^= turns
            if not inside:
                rows.append((*split, seq, "\n".join(open_text).removesuffix("\r"), not fresh, True))
                seq, open_text, fresh = seq + 1, None, False
        if rows:
            yield leave()
    if split is not None:
        end_split()
    yield leave()


def csv_records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """(file_path, block, seq, text): one row a record, whole, in whatever task its split
    is; lines are joined by ``\\n``. ``lines``: file_path, block, at, value (decoded)."""
    started = lines.join(splits.select("file_path", "block", "inside"), ["file_path", "block"])
    ordered = started.sortWithinPartitions("file_path", "block", "at").select("file_path", "block", "inside", "value")
    cut = ordered.mapInArrow(_cut_records, RECORDS)
    whole = cut.where("opens AND closes").select("file_path", "block", "seq", "text")
    parts = cut.where("NOT (opens AND closes)")
    # a record begins where a fragment opens; all until the next such belong to it
    order = W.partitionBy("file_path").orderBy("block", "seq").rowsBetween(W.unboundedPreceding, 0)
    numbered = parts.withColumn("record", F.sum(F.col("opens").cast("int")).over(order))
    joined = numbered.groupBy("file_path", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "seq", "text"))).alias("parts")).select(
        "file_path", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["seq"].alias("seq"),
        F.array_join("parts.text", "\n").alias("text"))
    return whole.unionByName(joined)


def cells_of(record: Column, delimiter: Column) -> Column:
    """Cells of a record: separators inside quotes do not separate, quotes around a cell
    go and doubled ones become one; an empty cell without quotes is null."""
    swapped = lambda c, *pairs: reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)
    marked = record.contains(MARK) | record.contains(ESCAPE)
    plain = F.when(marked, swapped(record, (ESCAPE, f"{ESCAPE}a"), (MARK, f"{ESCAPE}b"))).otherwise(record)
    outside = F.transform(F.split(plain, '"', -1), lambda part, i: F.when(
        i % 2 == 0, F.replace(part, delimiter, F.lit(MARK))).otherwise(part))
    cells = F.split(F.array_join(outside, '"'), MARK, -1)
    cells = F.when(marked, F.transform(cells, lambda c: swapped(c, (f"{ESCAPE}b", MARK), (f"{ESCAPE}a", ESCAPE)))).otherwise(cells)
    bare = lambda c: F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.transform(cells, lambda c: F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), bare(c)).when(c != "", c))

