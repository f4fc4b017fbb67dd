"""MinHash near-duplicates: banded candidates, odd sketches, links on full sets.

1. Documents with equal shingle sets are one class (128-bit keys, combined before the
   shuffle). All that follows is between classes, however many copies they have.
2. Bands of MinHash samples put classes into buckets. In a bucket every member is
   compared with one leader, not with all others: the member that meets most others in
   its buckets, as the text does from which copies were made. Of the leaders that its
   sketches allow a member keeps the closest; full sets confirm the link.
3. Buckets whose members are now one component are done. In the others, members of
   different components are compared: first with one member in ``LEADERS`` as leader,
   then all. Pairs of different components are thus all compared (no link between
   components is lost), and pairs inside one never need to be.

Sketches allow a pair when the odd sketches of their samples differ in no more bits
than those of similar sets would, and the parity bitmaps of their whole sets in no more
bits than linked sets may differ in shingles (which no linked pair exceeds).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.llm import shingles
from evenkeel.llm.common import cut, drop_tables, ship
from evenkeel.llm.components import connected_components

#: Shares of a bucket's members that lead, one round each.
LEADERS = (32, 1)
#: An odd sketch may underestimate the similarity by this much: of pairs exactly at the
#: threshold it then drops fewer than share no band (5 deviations at 0.80, 6 at 0.85).
SKETCH_SLACK = 0.18

SIGNATURE = ("doc_id bigint, n_shingles bigint, low bigint, high bigint, bands array<bigint>, sketch array<bigint>, "
             "parity array<bigint>")
SETS = "low bigint, high bigint, shingles array<bigint>"


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80,
                    identifier: str = "doc_id", text: str = "text", mark: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 · |A ∩ B| ≥ ``percent`` · |A ∪ B| for their sets of
    ``size``-word shingles. ``component_id`` is the smallest id reachable; a document is
    kept when that is its own. Null, empty and wordless texts have no shingles and are
    linked with nothing, not with each other. A null id stays null; such a row takes
    part, but names no component unless all of its members have none. Repeated rows are
    copies. Other columns are not read. An empty table gives no rows.

    With ``mark``, a bigint column that tells the rows of an id apart (a hash of the
    text), that column is carried along and ``kept`` is the row's own: of each component
    the one row (and its repetitions) with the smallest id, then shingle set, then mark;
    without ids one row of each component, too. Rows without shingles are all kept.
    """
    ship(docs.sparkSession)
    marks = [] if mark is None else ["mark"]
    rows = docs.select(F.col(identifier).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    marked = docs.select(F.col(identifier).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                         *([F.col(mark).alias("mark")] if marks else []))
    signed = cut(marked.mapInArrow(
        shingles.signatures(size), SIGNATURE + "".join(f", {m} bigint" for m in marks)), "signatures")
    signed_ids = signed.select("doc_id", "n_shingles", "low", "high", *marks)
    key = ["low", "high"]
    alone = F.col("n_shingles") == 0
    by_key = -F.shiftrightunsigned("low", 2) - (1 << 62)
    node = F.coalesce("first_id", by_key)
    if marks:  # classes of one id are not one node
        turn = F.row_number().over(W.partitionBy(node).orderBy(*key))
        node = F.when(turn == 1, node).otherwise(by_key)
    first = {c: F.first(c).alias(c) for c in ("bands", "sketch", "parity")}
    classes = cut(
        signed.where(~alone).groupBy(*key).agg(F.min("doc_id").alias("first_id"), *first.values(),
                                               F.first("n_shingles").alias("n"))
        .withColumn("node", node), "classes")

    banded = classes.select("node", F.posexplode("bands").alias("band", "value"))
    members = cut(banded.select("node", F.xxhash64("band", "value").alias("bucket")), "members")
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    shared = cut(members.join(sizes, "bucket"), "shared")
    degrees = shared.groupBy("node").agg(F.sum("size").alias("degree"))
    leading = F.max(F.struct("degree", F.xxhash64("node").alias("h"), F.col("node").alias("leader")))
    leaders = shared.join(degrees, "node").groupBy("bucket").agg(leading["leader"].alias("b"))
    drop_tables(docs.sparkSession, [members])

    met = cut(shared.select("node").distinct().join(
        classes.select("node", "first_id", *key, "sketch", "parity", "n"), "node"), "met")
    sets = cut(_sets(rows, met, size), "sets")
    profiles = met.select("node", F.struct("sketch", "parity", "n").alias("profile"))

    stars = shared.join(leaders, "bucket").where(F.col("node") != F.col("b")).select(
        F.col("node").alias("a"), "b").distinct()
    both = _beside(_beside(stars, profiles, "a", "profile"), profiles, "b", "profile")
    odd = _odd_bits("profile_a.sketch", "profile_b.sketch", shingles.SKETCH_BITS)
    closest = both.where(_allowed("profile_a", "profile_b", percent)).groupBy("a").agg(
        F.min(F.struct(odd.alias("odd"), F.xxhash64("b").alias("h"), "b"))["b"].alias("b"))
    labels = _relabelled(met.select("node", F.col("node").alias("label")), _links(closest, sets, percent))
    for share in LEADERS:
        placed = shared.select("bucket", "node").join(labels, "node")
        open_buckets = placed.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where(
            F.col("lo") != F.col("hi")).select("bucket")
        active = cut(placed.join(open_buckets, "bucket").join(profiles, "node"), "active")
        if active.isEmpty():
            break
        leads = F.pmod(F.xxhash64("node"), F.lit(share)) == 0
        ahead = active.where(leads).select("bucket", F.col("node").alias("b"), F.col("label").alias("label_b"),
                                           F.col("profile").alias("profile_b"))
        pairs = active.join(ahead, "bucket").where(
            (F.col("label") != F.col("label_b")) & ((F.col("node") < F.col("b")) | ~leads)
            & _allowed("profile", "profile_b", percent)).select(
            F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
        labels = _relabelled(labels, _links(pairs, sets, percent))
        drop_tables(docs.sparkSession, [active])

    named = classes.select("first_id", "node", *key).join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    # of the classes with a component's smallest id the first by key; without ids, of all
    first_class = F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", *key))
    least = named.groupBy("label").agg(first_class.alias("least"))
    chosen = F.struct(*key) == F.struct(F.col("least.low").alias("low"), F.col("least.high").alias("high"))
    found = cut(named.join(least, "label").select(
        *key, F.col("least.first_id").alias("component_id"), chosen.alias("chosen")), "found")
    joined = signed_ids.where(~alone).join(found, key, "left").unionByName(
        signed_ids.where(alone).withColumns({"component_id": F.col("doc_id"), "chosen": F.lit(True)}))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    if not marks:
        return joined.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
    # rows of the chosen class and id: the one with the smallest mark
    marks_of = joined.where(kept & F.col("chosen") & ~alone).groupBy(*key).agg(F.min("mark").alias("_least"))
    return joined.join(marks_of, key, "left").select("doc_id", "n_shingles", "component_id", "mark", (
        alone | (kept & F.col("chosen") & F.coalesce(F.col("mark") == F.col("_least"), F.lit(False)))).alias("kept"))


def _sets(rows: DataFrame, met: DataFrame, size: int) -> DataFrame:
    """Full sets of the classes that share a bucket, from their first documents' texts."""
    # as many ids as there are near copies: they grow with the documents, so no broadcast
    wanted = met.select(F.col("first_id").alias("id")).hint("merge")
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")
    full = texts.mapInArrow(shingles.full_sets(size), SETS)
    found = full.join(met.select("low", "high", "node"), ["low", "high"])
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _beside(pairs: DataFrame, values: DataFrame, end: str, value: str) -> DataFrame:
    return pairs.join(values.select(F.col("node").alias(end), F.col(value).alias(f"{value}_{end}")), end)


def _odd_bits(left: str, right: str, bits: int) -> Column:
    counts = [F.bit_count(F.get(left, F.lit(i)).bitwiseXOR(F.get(right, F.lit(i)))) for i in range(bits // 64)]
    return sum(counts[1:], counts[0])


def _allowed(left: str, right: str, percent: int) -> Column:
    """Whether the sketches of two classes leave room for a link."""
    sampled = _odd_bits(f"{left}.sketch", f"{right}.sketch", shingles.SKETCH_BITS)
    whole = _odd_bits(f"{left}.parity", f"{right}.parity", shingles.PARITY_BITS)
    sizes = F.col(f"{left}.n") + F.col(f"{right}.n")
    return ((sampled <= shingles.most_odd_bits(percent / 100 - SKETCH_SLACK))
            & (whole * (100 + percent) <= (100 - percent) * sizes))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that are linked, by their full sets."""
    both = _beside(_beside(pairs.select("a", "b"), sets, "a", "shingles"), sets, "b", "shingles")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - common
    return both.where(100 * common >= percent * union).select("a", "b")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after the links have merged the components they join."""
    ends = _beside(_beside(links, labels, "a", "label"), labels, "b", "label")
    merged = connected_components(ends.select("label_a", "label_b"), "label_a", "label_b")
    renamed = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
    joined = labels.join(renamed, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return cut(joined, "labels")
