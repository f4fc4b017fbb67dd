"""Token files: Arrow streams in files, fixed-size-list batches of equal-length sequences and masks.

A file ``part-0000000007.arrows`` holds the ids of a run of documents, cut into sequences
of ``length`` ids (``ids``) with a ``mask`` that is true where an id is real; only a
file's last sequence is padded. All batches but the last hold ``BATCH_SEQUENCES``
sequences, so a sequence's place follows from its number, and a memory-mapped file
yields arrays over the file's own pages. ``part-0000000007.docs.arrows`` tells where the
documents of that file start. Files in the order of their names hold documents in
ascending order of id.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.llm.common import cut, new_path, ship

SEQUENCE = 2048
BATCH_SEQUENCES = 256
MANIFEST = "part int, path string, docs bigint, tokens bigint"


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int,
    length: int = SEQUENCE,
    dtype: str = "<u2",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Write all documents in ascending order of id; return one row per file.

    Documents are dealt by ranges of ids, each task streams its range into one file
    (a few batches in memory), first under a name of its own, then renamed: a task
    that runs again replaces its file by an equal one. The folder must be one that
    all executors reach (any URI pyarrow opens).

    Null or empty text: ``end_id`` alone. Null ids come first, equal ids in the order
    of their texts. Other columns are not read. An empty table makes no file.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return cut(ordered.mapInArrow(_writer(tokenizer, folder, end_id, length, dtype), MANIFEST), "token-files")


def read_token_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Documents as the files hold them: id, position in the whole stream, ids.

    ``start`` counts the ids of all documents before: the totals of the files before
    (one row a file) plus the position inside the file. ``ids`` are little-endian
    unsigned 32-bit, whatever their width in the file.
    """
    ship(spark)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    placed = files.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    dealt = placed.repartition(max(1, files.count()), "path")  # rows are few and small: a stated number is not merged
    return dealt.mapInArrow(_reader, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def open_sequences(path: str) -> "Sequences":
    return Sequences(path)


class Sequences:
    """Random access to the sequences of one file, without copying."""

    def __init__(self, path: str):
        self.batches = [b for b in _stream(path)]
        self.count = sum(b.num_rows for b in self.batches)

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, i: int):
        """(ids, mask): an array and an Arrow array (a bit each) over the file's memory."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        batch, row = self.batches[i // BATCH_SEQUENCES], i % BATCH_SEQUENCES
        return _view(batch, "ids", row, row + 1).to_numpy(zero_copy_only=True), _view(batch, "mask", row, row + 1)

    def flat(self, start: int, stop: int):
        """Ids from position ``start`` to ``stop`` of the file's stream."""
        import numpy as np

        if not self.batches or stop <= start:
            return np.zeros(0, "<u4")
        length = self.batches[0].schema.field("ids").type.list_size
        step, out = length * BATCH_SEQUENCES, []
        for b in range(start // step, (stop - 1) // step + 1):
            values = _view(self.batches[b], "ids", 0, self.batches[b].num_rows).to_numpy(zero_copy_only=True)
            out.append(values[max(0, start - b * step):stop - b * step])
        return out[0] if len(out) == 1 else np.concatenate(out)


def _view(batch, name: str, first: int, last: int):
    column = batch.column(batch.schema.get_field_index(name))
    width = column.type.list_size
    return column.values.slice((column.offset + first) * width, (last - first) * width)


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _stream(uri: str) -> Iterator:
    import pyarrow as pa
    from pyarrow import fs

    store, path = _store(uri)
    source = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)
    yield from pa.ipc.open_stream(source)


def _writer(tokenizer: str, folder: str, end_id: int, length: int, dtype: str):
    def write(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from evenkeel.llm.tokens import encoder

        encode, end = encoder(tokenizer, dtype).encode, np.array([end_id], dtype).tobytes()
        width, part = np.dtype(dtype).itemsize, TaskContext.get().partitionId()
        store, top = _store(folder)
        name = f"{top}/part-{part:010d}"
        mine = f"{top}/.writing-{part:010d}-{TaskContext.get().taskAttemptId()}"
        kind = pa.from_numpy_dtype(np.dtype(dtype))
        schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        doc_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        held, held_bytes, written, docs = [], 0, 0, 0
        step = length * BATCH_SEQUENCES * width

        def batch_of(raw: bytes):
            real = len(raw) // width
            ids = np.zeros(-(-real // length) * length, dtype)
            ids[:real] = np.frombuffer(raw, dtype)
            mask = np.arange(len(ids)) < real
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(a), length) for a in (ids, mask)]
            return pa.RecordBatch.from_arrays(lists, schema=schema)

        stream = doc_stream = None
        for batch in batches:
            if batch.num_rows and stream is None:
                store.create_dir(top, recursive=True)
                sinks = [store.open_output_stream(mine + x) for x in (".arrows", ".docs.arrows")]
                stream, doc_stream = pa.ipc.new_stream(sinks[0], schema), pa.ipc.new_stream(sinks[1], doc_schema)
            if not batch.num_rows:
                continue
            ids = [x + end for x in encode(batch.column(1))]
            counts = np.array([len(x) // width for x in ids], np.int64)
            starts = written + np.cumsum(counts) - counts
            doc_stream.write_batch(pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(starts), pa.array(counts)], schema=doc_schema))
            written, docs = written + int(counts.sum()), docs + len(ids)
            held += ids
            held_bytes += sum(map(len, ids))
            if held_bytes >= step:
                raw = b"".join(held)
                whole = len(raw) // step * step
                for i in range(0, whole, step):
                    stream.write_batch(batch_of(raw[i:i + step]))
                held, held_bytes = [raw[whole:]], len(raw) - whole
        if stream is None:
            return
        if held_bytes:
            stream.write_batch(batch_of(b"".join(held)))
        for x in (stream, doc_stream, *sinks):
            x.close()
        for x in (".docs.arrows", ".arrows"):
            store.move(mine + x, name + x)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "path": pa.array([f"{folder}/part-{part:010d}"]),
            "docs": pa.array([docs], pa.int64()), "tokens": pa.array([written], pa.int64())})

    return write


def _reader(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sequences = Sequences(path + ".arrows")
            for docs in _stream(path + ".docs.arrows"):
                starts, counts = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                ids = [sequences.flat(s, s + n).astype("<u4").tobytes()
                       for s, n in zip(starts.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": docs.column(0), "start": pa.array(np.int64(base) + starts),
                    "n_tokens": docs.column(2), "ids": pa.array(ids, pa.binary())})


def token_folder(spark: SparkSession) -> str:
    return new_path(spark, "tokens")
