"""Ranked lexical search: term at a time, rarest first, with a limited set of accumulators."""

from __future__ import annotations

import collections
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.llm.common import cut, ship

#: Items whose terms are asked for together, by bytes of their texts (on average; an
#: item is never split): bounds what the driver holds and a task is sent.
ITEM_BYTES = 8_000_000
#: Documents of one inverted index: bounds a task's memory.
INDEX_DOCUMENTS = 65_536
#: Postings of one inverted index, unless one document has more.
INDEX_POSTINGS = 8_000_000

# Fixed values of the scoring rule.
WEIGHT_SCALE, TF_SCALE, TF_PART, LENGTH_PART, BASE, SLOPE = 1000, 1_000_000_000, 1000, 8, 100, 75

_TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII; only A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_TERMS).split()


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0.

    Items are dealt to blocks by hash; a block's terms travel to the documents. One pass
    over the texts keeps, per document, its number of terms and the block's terms in it;
    statistics of the collection come from that table. Then every task builds inverted
    indexes over its own documents (no shuffle, so no term or source is a hot key) and
    ranks all items of the block against each, exactly: an item's terms go rarest first;
    once the terms left cannot lift a document without an accumulator to the ``k``-th
    partial score, only documents with one are updated, to the end. Ranks over all
    indexes follow from their ``k`` best.

    Equal scores: ascending id, null ids last. Null or empty texts, of documents and of
    items, have no terms: such documents only fail to count, such items get no rows.
    Repeated rows are documents (and items) of their own; ranks of items that share an id
    are separate. Other columns are not read. An empty table on either side: no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = cut(items.select(F.col(item_id).cast("bigint").alias("item_id"), F.coalesce(item_text, F.lit("")).alias("text")).withColumn(
        "item", F.monotonically_increasing_id()), "items")
    blocks = max(1, -(-int(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // ITEM_BYTES))
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(doc_text).alias("text"))
    found = [_ranked(texts, asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), k) for b in range(blocks)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _ranked(texts: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """All ranks of one block of items (bounded by ``ITEM_BYTES``)."""
    spark = texts.sparkSession
    queries = [(r["item"], collections.Counter(terms_of(r["text"]))) for r in asked.collect()]
    numbers = {t: i for i, t in enumerate(sorted(set().union(*(q for _, q in queries))))}
    sent = spark.sparkContext.broadcast(numbers)
    hits = cut(texts.mapInArrow(_finder(sent), "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"), "term-hits")
    size = hits.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    held = hits.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one row a term of the block
    weight = {r["term"]: math.floor(WEIGHT_SCALE * math.log((2 * size["n"] + 2) / (2 * r["count"] + 1))) for r in held}
    df = {r["term"]: r["count"] for r in held}
    plans = []
    for item, terms in queries:
        known = sorted((df[numbers[t]], numbers[t], times * weight[numbers[t]]) for t, times in terms.items() if numbers[t] in df)
        plans.append((item, [(t, w) for _, t, w in known if w > 0]))
    best = hits.where(F.size("terms") > 0).mapInArrow(
        _ranker(spark.sparkContext.broadcast(plans), size["n"], size["l"], k), "item bigint, doc_id bigint, score bigint")
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    placed = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return placed.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _finder(sent):
    """Documents → number of terms, the asked-for terms in them and how often they occur."""
    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        numbers = sent.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 1024):
                counts, ends, terms, tfs = [], [0], [], []
                for text in texts.slice(at, 1024).to_pylist():
                    words = terms_of(text)
                    counts.append(len(words))
                    for word, times in collections.Counter(words).items():
                        number = numbers.get(word)
                        if number is not None:
                            terms.append(number)
                            tfs.append(times)
                    ends.append(len(terms))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, t))
                         for v, t in ((terms, pa.int32()), (tfs, pa.int64()))]
                yield pa.RecordBatch.from_arrays([ids.slice(at, 1024), pa.array(counts, pa.int64()), *lists],
                                                 names=["doc_id", "n", "terms", "tfs"])
    return find


class Index:
    """Inverted lists of some documents with what a term adds to a document's score for
    each unit of the term's weight."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, tfs: np.ndarray, m: np.ndarray):
        order = np.argsort(terms, kind="stable")
        terms, self.docs = terms[order], docs[order]
        self.gains = TF_SCALE * tfs[order] // (TF_PART * tfs[order] + LENGTH_PART * m[self.docs])
        names, first = np.unique(terms, return_index=True)
        ends = np.append(first[1:], len(terms))
        self.lists = {t: (a, b) for t, a, b in zip(names.tolist(), first.tolist(), ends.tolist())}
        self.most = dict(zip(names.tolist(), np.maximum.reduceat(self.gains, first).tolist() if len(first) else []))
        self.n = len(m)

    def best(self, plan: list[tuple[int, int]], k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` best. ``plan``: (term, weight), rarest first;
        ``ids`` breaks ties, smaller first."""
        plan = [(t, w) for t, w in plan if t in self.lists]
        left = np.cumsum([w * self.most[t] for t, w in plan][::-1])[::-1].tolist() if plan else []
        score, held = np.zeros(self.n, np.int64), np.zeros(self.n, bool)
        created, limit = 0, 0  # accumulators; the k-th best partial score
        survivors = None
        for (term, weight), bound in zip(plan, left):
            a, b = self.lists[term]
            docs, gains = self.docs[a:b], self.gains[a:b]
            if survivors is None and created >= k:
                partial = score[held]
                limit = int(np.partition(partial, len(partial) - k)[len(partial) - k])
                if bound < limit:  # no new document can reach the k-th; a tie could
                    survivors = np.flatnonzero(held)
            if survivors is None:
                score[docs] += weight * gains
                held[docs] = True
                created = np.count_nonzero(held)
            elif 16 * len(survivors) < len(docs):
                at = np.minimum(np.searchsorted(docs, survivors), len(docs) - 1)
                met = docs[at] == survivors
                score[survivors[met]] += weight * gains[at[met]]
            else:
                met = held[docs]
                score[docs[met]] += weight * gains[met]
        some = np.flatnonzero(score > 0)
        if len(some) > k:  # all ties of the last place stay for the order by id
            least = np.partition(score[some], len(some) - k)[len(some) - k]
            some = some[score[some] >= least]
        some = some[np.lexsort((ids[some], -score[some]))[:k]]
        return some, score[some]


def _ranker(sent, n_docs: int, n_terms: int, k: int):
    def rank(batches: Iterator) -> Iterator:
        import pyarrow as pa

        plans = sent.value
        held, rows, postings = [], 0, 0

        def ranked():
            whole = pa.Table.from_batches(held).combine_chunks()
            ids, n = whole.column("doc_id").combine_chunks(), whole.column("n").to_numpy()
            terms, tfs = (whole.column(c).combine_chunks() for c in ("terms", "tfs"))
            sizes = terms.value_lengths().to_numpy()
            m = BASE - SLOPE + SLOPE * n * n_docs // n_terms
            index = Index(terms.flatten().to_numpy(), np.repeat(np.arange(len(n)), sizes), tfs.flatten().to_numpy(), m)
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            order = np.empty(len(n), np.int64)
            order[np.lexsort((ids.fill_null(0).to_numpy(), missing))] = np.arange(len(n))
            items, places, scores = [], [], []
            for item, plan in plans:
                docs, score = index.best(plan, k, order)
                items += [item] * len(docs)
                places.append(docs)
                scores.append(score)
            at = np.concatenate(places) if places else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int64()), ids.take(pa.array(at)), pa.array(np.concatenate(scores) if scores else at)],
                names=["item", "doc_id", "score"])

        for batch in batches:
            step = 1024
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                held.append(part)
                rows += part.num_rows
                postings += len(part.column(2).flatten())
                if rows >= INDEX_DOCUMENTS or postings >= INDEX_POSTINGS:
                    yield ranked()
                    held, rows, postings = [], 0, 0
        if held:
            yield ranked()

    return rank
