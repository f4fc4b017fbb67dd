"""Packing: first-fit decreasing with a tournament tree, in randomised groups of documents."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import ship

#: Documents that are packed together, on average.
GROUP_DOCUMENTS = 2048
#: Bytes of ids that a task hands on at once.
OUT_BYTES = 8_000_000

PIECES = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, padded bigint")


class Tournament:
    """Room left in the open bins; each node holds the largest room below it."""

    def __init__(self, capacity: int, leaves: int):
        self.capacity, self.size = capacity, 1 << max(0, leaves - 1).bit_length()
        self.room = [capacity] * (2 * self.size)

    def place(self, length: int) -> int:
        """Leftmost bin with room for ``length``; takes that room."""
        room, node, size = self.room, 1, self.size
        while node < size:
            node *= 2
            if room[node] < length:
                node += 1
        room[node] -= length
        leaf, node = node - size, node // 2
        while node:
            left, right = room[2 * node], room[2 * node + 1]
            room[node] = left if left > right else right
            node //= 2
        return leaf


def first_fit_decreasing(lengths: Sequence[int], capacity: int) -> list[int]:
    """Bin of each piece. Longest first, equal lengths in their order."""
    tree, bins = Tournament(capacity, len(lengths)), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bins[i] = tree.place(lengths[i])
    return bins


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    length: int = 1024,
    end_id: int = 0,
    group_documents: int = GROUP_DOCUMENTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of documents, placed in sequences of at most ``length`` tokens.

    Each row is a document: the ids of its text, then ``end_id``. Every full
    ``length`` of a document is a sequence; what remains is one piece, packed with the
    pieces of its group. A row's group is drawn by a hash of its content and its place
    in the table, so groups are alike however often rows repeat, and none waits for
    another. A task holds the remains of one group; full sequences leave at once.

    Null or empty text: a document of ``end_id`` alone. Null ids stay null. Repeated
    rows are documents of their own. Other columns are not read. An empty table gives
    no rows. ``ids`` are little-endian unsigned 32-bit, ``padded`` is the length that
    the piece's sequence is padded to (``length``, or its own if a power of two).
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    groups = max(1, -(-docs.count() // group_documents))
    place = F.monotonically_increasing_id()
    grouped = rows.withColumn("group", F.pmod(F.xxhash64("doc_id", "text", place), F.lit(groups)))
    dealt = grouped.repartition("group").sortWithinPartitions("group", "doc_id", "text")
    return dealt.mapInArrow(_packer(tokenizer, length, end_id), PIECES)


def _packer(tokenizer: str, length: int, end_id: int):
    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from evenkeel.llm.tokens import encoder

        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded")
        out: dict[str, list] = {n: [] for n in names}
        group, made, rests, size = None, 0, [], 0

        def add(doc, start, ids, total, sequence, offset, padded):
            nonlocal size
            size += len(ids)
            for name, value in zip(names, (doc, start, len(ids) // 4, ids, total, (group << 32) + sequence, offset, padded)):
                out[name].append(value)

        def close_group():
            bins = first_fit_decreasing([len(ids) // 4 for _, _, ids, _ in rests], length)
            filled, offsets = [0] * len(rests), []
            for (_, _, ids, _), b in zip(rests, bins):
                offsets.append(filled[b])
                filled[b] += len(ids) // 4
            for (doc, start, ids, total), b, offset in zip(rests, bins, offsets):
                n = filled[b]
                add(doc, start, ids, total, made + b, offset, n if n & (n - 1) == 0 else length)
            rests.clear()

        def leave():
            nonlocal size
            batch = pa.RecordBatch.from_pydict(
                {n: pa.array(v, pa.binary() if n == "ids" else pa.int64()) for n, v in out.items()})
            for values in out.values():
                values.clear()
            size = 0
            return batch

        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            for key, doc, ids in zip(column("group").to_pylist(), column("doc_id").to_pylist(), encode(column("text"))):
                if key != group:
                    close_group()
                    group, made = key, 0
                ids += end
                total = len(ids) // 4
                for start in range(0, total - length + 1, length):
                    add(doc, start, ids[4 * start:4 * (start + length)], total, made, 0, length)
                    made += 1
                if rest := total % length:
                    rests.append((doc, total - rest, ids[4 * (total - rest):], total))
                if size >= OUT_BYTES:
                    yield leave()
        close_group()
        yield leave()

    return pack
