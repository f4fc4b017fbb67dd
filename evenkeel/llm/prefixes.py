"""Conversation prefix trie: union-find over the common prefixes of sorted neighbours.

Sorted conversations are cut into runs. In a run the edges between neighbours, deepest
common prefix first, merge components; each merge makes a branching node. Nodes on the
path of a run's first or last conversation may go on in the next run: they leave as
partial nodes named by a digest of their prefix, and are added up by name together with
a correction for what two neighbouring runs share. All other nodes are finished.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.llm.common import cut, ship

#: Conversations and turns of a run (one conversation may be longer): bounds a task's memory.
RUN_CONVERSATIONS, RUN_TURNS = 20_000, 400_000
DIGEST = 16
NOTHING = hashlib.sha256(b"").hexdigest()

NODE = ("name binary, parent binary, depth bigint, least bigint, parent_least bigint, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved bigint, ends string")
EDGES = "part int, first binary, first_sizes array<bigint>, last binary"


def turn_digest(role: Column, text: Column) -> Column:
    """What makes two turns equal, as 32 hex digits."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns as (digest, bytes of the text), in the
    order of ``turn`` (null first); turns of one number by their digest. Rows without a
    conversation are left out. A conversation is ordered in one task."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), turn_digest(role, text).alias("digest"),
                    F.octet_length(text).cast("bigint").alias("bytes"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["digest"], t["bytes"])).alias("turns"))


def share_openings(conversations: DataFrame, families: int = 5, most: int = 8) -> DataFrame:
    """Give every conversation c the opening of conversation ``c - c % families``: its
    first h turns (all if fewer, none if there is no such conversation) stand for c's
    own first h, where h is the CRC-32 of c in decimals modulo ``most`` + 1."""
    base = F.col("conv_id") - F.col("conv_id") % families
    heads = conversations.where(F.col("conv_id") % families == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("opening"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    joined = conversations.withColumn("base", base).join(heads, "base", "left").withColumn("h", h)
    opening = F.coalesce(F.slice("opening", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(0)))
    return joined.select("conv_id", F.concat(opening, own).alias("turns"))


def prefix_trie(conversations: DataFrame, run_conversations: int = RUN_CONVERSATIONS, run_turns: int = RUN_TURNS) -> DataFrame:
    """One row per node of the trie of ``conversations`` (conv_id, turns as ``sequences``
    gives them): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (bytes that members need not repeat, over the subtree) and
    ends_sha256 (of the members that end there).

    Equal conversations are counted before anything is sorted, so a hot one is one
    sequence; only its ids, 24 bytes each, meet in one task, where they stream through
    the digest. Distinct sequences are dealt by ranges. No conversations: no nodes (a
    conversation without turns is a member of the root). Conversations that share an id
    would be members of their own.
    """
    ship(conversations.sparkSession)
    whole = cut(conversations.select("conv_id", F.unhex(F.array_join("turns.digest", "")).alias("key"), F.col("turns.bytes").alias("sizes"))
                .withColumn("name", F.unhex(F.md5("key"))), "conversations")
    ids = whole.select("name", "conv_id").repartition("name").sortWithinPartitions("name", "conv_id")
    ends = ids.mapInArrow(_ends, "name binary, ends string")
    counted = whole.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"),
                                        F.first("key").alias("key"), F.first("sizes").alias("sizes"))
    sorted_ = counted.join(ends, "name").select("key", "sizes", "n", "least", "ends").repartitionByRange("key").sortWithinPartitions("key")
    grown = cut(sorted_.mapInArrow(_forest(run_conversations, run_turns), f"{NODE}, {EDGES}"), "forest")

    nodes = [c.split()[0] for c in NODE.split(", ")]
    made = grown.where("part is null").select(nodes)
    border = grown.where("part is not null").select("part", "first", "first_sizes", F.lag("last").over(W.orderBy("part")).alias("before"))
    shared = border.where("before is not null").select("before", "first", "first_sizes").mapInArrow(_corrections, NODE)
    partial = made.where("name is not null").unionByName(shared)
    open_ = cut(partial.groupBy("name").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("least").alias("least"),
        *[F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved")], F.max("ends").alias("ends")), "open-nodes")
    parents = open_.select(F.col("name").alias("parent"), F.col("least").alias("of"))
    closed = made.where("name is null")
    inner = closed.where("parent is null").withColumn("of", F.col("parent_least"))
    hanging = closed.where("parent is not null").drop("name").unionByName(
        open_.drop("name").withColumn("parent_least", F.lit(None).cast("bigint"))).join(parents, "parent", "left")
    return inner.drop("name").unionByName(hanging).select(
        F.col("least").alias("conv_id"), "depth", F.col("of").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))


def _ends(batches: Iterator) -> Iterator:
    """Rows sorted by name and id → digest of each name's ids, joined by commas."""
    import pyarrow as pa

    name, digest = None, None
    for batch in batches:
        names, found = [], []
        for this, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if this != name:
                if digest is not None:
                    names.append(name)
                    found.append(digest.hexdigest())
                name, digest = this, hashlib.sha256(b"%d" % conv)
            else:
                digest.update(b",%d" % conv)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.string())], names=["name", "ends"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.hexdigest()])], names=["name", "ends"])


def common_depth(a: bytes, b: bytes) -> int:
    """Turns that two sequences share at their beginning."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    if a[:high * DIGEST] == b[:high * DIGEST]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle * DIGEST] == b[:middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


def names_along(key: bytes) -> list[bytes]:
    """Names of the nodes on a sequence's path, from the root."""
    digest, out = hashlib.md5(b""), [hashlib.md5(b"").digest()]
    for at in range(0, len(key), DIGEST):
        digest.update(key[at:at + DIGEST])
        out.append(digest.copy().digest())
    return out


class Run:
    """The forest of some sorted, distinct sequences. A component is one subtree: its
    node of least depth so far, with sums over it; ``lo`` and ``hi`` are its first and
    last sequence."""

    def __init__(self, keys: list[bytes], sizes: list[list[int]], counts: list[int], least: list[int], ends: list[str]):
        self.keys, self.least_of, self.ends_of = keys, least, ends
        self.upto = []  # bytes of a sequence's texts up to each depth
        for row in sizes:
            sums = [0]
            for x in row:
                sums.append(sums[-1] + x)
            self.upto.append(sums)
        n = len(keys)
        self.root = list(range(n))  # union-find: parent, the first sequence leads
        self.hi = list(range(n))
        self.depth = [len(k) // DIGEST for k in keys]
        self.n, self.least = list(counts), list(least)
        self.children, self.leaves = [0] * n, [1] * n
        self.ends: list[str | None] = list(ends)  # of the component's top node
        # bytes that members hold, and bytes that remain, from the top node's text on
        self.held = [c * self._bytes(i, d, d) for i, (c, d) in enumerate(zip(counts, self.depth))]
        self.kept = [self._bytes(i, d, d) for i, d in enumerate(self.depth)]
        self.waiting: list[list[int]] = [[] for _ in range(n)]  # finished children of the top node
        self.made: list[list] = []  # depth, least, parent's place, n, children, leaves, saved, ends, lo, hi

    def _bytes(self, i: int, first: int, last: int) -> int:
        """Bytes of sequence ``i`` at the depths from ``first`` to ``last``; the root has none."""
        return self.upto[i][last] - self.upto[i][max(first, 1) - 1] if last >= 1 else 0

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def _finish(self, c: int) -> int:
        """The component's top node is complete: a row."""
        at = len(self.made)
        self.made.append([self.depth[c], self.least[c], None, self.n[c], self.children[c], self.leaves[c],
                          self.held[c] - self.kept[c], self.ends[c], c, self.hi[c]])
        for child in self.waiting[c]:
            self.made[child][2] = at
        return at

    def lift(self, c: int, depth: int) -> None:
        """Raise a component to ``depth``: nodes in between have one child each."""
        while self.depth[c] > depth:
            self.waiting[c] = [self._finish(c)]
            self.depth[c] -= 1
            more = self._bytes(c, self.depth[c], self.depth[c])
            self.held[c] += self.n[c] * more
            self.kept[c] += more
            self.children[c], self.ends[c] = 1, None

    def merge(self, j: int, depth: int) -> None:
        """Sequences ``j - 1`` and ``j`` share ``depth`` turns: the node there gets the
        component of ``j`` as one more child. Edges of one depth come from left to right."""
        a, b = self.find(j - 1), self.find(j)
        self.lift(a, depth)
        self.lift(b, depth + 1)
        child = self._finish(b)
        text = self._bytes(a, depth, depth)
        self.leaves[a] = self.leaves[b] + (self.leaves[a] if self.children[a] else 0)
        self.children[a] += 1
        self.waiting[a].append(child)
        self.n[a] += self.n[b]
        self.least[a] = min(self.least[a], self.least[b])
        self.held[a] += self.held[b] + self.n[b] * text
        self.kept[a] += self.kept[b]
        self.root[b], self.hi[a] = a, self.hi[b]

    def grow(self) -> "Run":
        depths = [common_depth(a, b) for a, b in zip(self.keys, self.keys[1:])]
        for i in sorted(range(len(depths)), key=lambda i: (-depths[i], i)):
            self.merge(i + 1, depths[i])
        self.lift(0, 0)
        self._finish(0)
        return self

    def rows(self) -> list[tuple]:
        """(name, parent, depth, least, parent_least, n, children, leaves, saved, ends):
        names only for nodes that may go on in another run, a parent's name only where
        the parent may."""
        last = len(self.keys) - 1
        left, right = names_along(self.keys[0]), names_along(self.keys[last])
        out = []
        for depth, least, parent, n, children, leaves, saved, ends, lo, hi in self.made:
            path = left if lo == 0 else right if hi == last else None
            above = None
            if parent is not None:
                _, of, _, _, _, _, _, _, plo, phi = self.made[parent]
                above = left if plo == 0 else right if phi == last else None
            out.append((path[depth] if path else None, above[depth - 1] if above else None, depth, least,
                        of if parent is not None and above is None else None, n, children, leaves, saved, ends))
        return out


def shared_rows(before: bytes, first: bytes, sizes: list[int]) -> list[tuple]:
    """What the nodes on the common path of two runs' neighbours count twice."""
    depth = common_depth(before, first)
    names, out = names_along(first[:depth * DIGEST]), []
    twice = 0
    ends_inside = len(before) // DIGEST == depth  # the last sequence was no leaf after all
    for d in range(depth, -1, -1):
        twice += sizes[d - 1] if d else 0
        out.append((names[d], names[d - 1] if d else None, d, None, None, 0, -1 if d < depth else 0, -1 if ends_inside else 0, twice, None))
    return out


def _columns(rows: list[tuple]) -> tuple[list, list[str]]:
    import pyarrow as pa

    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string()]
    values = list(zip(*rows)) if rows else [()] * len(kinds)
    return [pa.array(list(v), k) for v, k in zip(values, kinds)], [c.split()[0] for c in NODE.split(", ")]


def _forest(run_conversations: int, run_turns: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        edge_names = [c.split()[0] for c in EDGES.split(", ")]
        edge_kinds = [pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.binary()]

        def made(rows, edge=None):
            columns, names = _columns(rows)
            edges = [pa.nulls(len(rows), k) for k in edge_kinds] if edge is None else [pa.array([x], k) for x, k in zip(edge, edge_kinds)]
            return pa.RecordBatch.from_arrays(columns + edges, names=names + edge_names)

        held: list[list] = [[], [], [], [], []]
        turns, first, last = 0, None, None
        for batch in batches:
            for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("key", "sizes", "n", "least", "ends"))):
                if held[0] and (len(held[0]) >= run_conversations or turns >= run_turns):
                    yield made(Run(*held).grow().rows() + shared_rows(held[0][-1], row[0], row[1]))
                    held, turns = [[], [], [], [], []], 0
                for values, value in zip(held, row):
                    values.append(value)
                turns += len(row[1])
                first = first or (row[0], row[1])
                last = row[0]
        if held[0]:
            yield made(Run(*held).grow().rows())
            yield made([(None,) * 10], (TaskContext.get().partitionId(), *first, last))

    return run


def _corrections(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        rows = []
        for before, first, sizes in zip(*(batch.column(i).to_pylist() for i in range(3))):
            rows += shared_rows(before, first, sizes)
        columns, names = _columns(rows)
        yield pa.RecordBatch.from_arrays(columns, names=names)
