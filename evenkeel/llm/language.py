"""Language identification: known words first, else ever shorter character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from evenkeel.llm.common import carried, cut, ship


#: The model is fitted on about this many labelled documents, chosen by hash: all of the
#: rare languages and as many of each other one, ``LEAST_DOCUMENTS`` at least (so more
#: than ``SAMPLE_DOCUMENTS`` in all where there are more than 64 languages).
SAMPLE_DOCUMENTS, LEAST_DOCUMENTS = 8_000, 125
#: Words, and n-grams of each length, of a language; fewer where many languages would
#: make the model exceed ``NUMBERS`` (it holds one a name and language).
WORDS, GRAMS = 20_000, 5_000
NUMBERS = 1 << 25
LONGEST = 4
#: Words a worker remembers besides the known ones.
REMEMBERED = 300_000
#: Values of the hash that chooses the sample.
HASHES = 1 << 40
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    languages: list[str]
    index: dict[str, int]  # word, or n-gram with a length mark → row
    rows: np.ndarray  # log frequency by language


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", identifier: str = "doc_id",
                  sample: int = SAMPLE_DOCUMENTS) -> Model:
    """Log frequencies of the ``WORDS`` commonest words and ``GRAMS`` commonest n-grams of
    each length, per language, from a hash sample of about ``sample`` labelled rows: all
    languages share it evenly, and what rare ones leave goes to the others. What comes
    to the driver is bounded by these numbers and that of the languages."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(identifier, text).alias("h"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    room = max(evenly(list(sizes.values()), sample), LEAST_DOCUMENTS)
    shares = [F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, int(min(1.0, room / n) * HASHES))]
    chosen = cut(labelled.where(F.pmod("h", F.lit(HASHES)) < F.element_at(F.create_map(*shares), F.col("lang"))
                                if shares else F.lit(False)).select("lang", "text"), "labelled")  # written once
    spoken = chosen.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    words = spoken.groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n"))
    padded = F.concat(F.lit(" "), F.col("w"), F.lit(" "))
    grams = F.flatten(F.array(*[F.transform(
        F.when(F.length(padded) >= k, F.sequence(F.lit(1), F.length(padded) - k + 1)).otherwise(F.array().cast("array<int>")),
        lambda i, k=k: F.substring(padded, i, F.lit(k))) for k in range(1, LONGEST + 1)]))
    counted = words.select("lang", F.explode(grams).alias("w"), "n").groupBy("lang", "w").agg(F.sum("n").alias("n"))
    every = words.select("lang", F.lit(0).alias("size"), "w", "n").unionByName(
        counted.select("lang", F.length("w").alias("size"), "w", "n"))
    order = W.partitionBy("lang", "size").orderBy(F.desc("n"), "w")
    scale = min(1.0, NUMBERS / ((WORDS + LONGEST * GRAMS) * max(1, len(sizes)) ** 2))
    most = [max(1, int(n * scale)) for n in (WORDS, GRAMS)]
    found = every.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= F.when(F.col("size") == 0, most[0]).otherwise(most[1])).select("lang", "size", "w", "n").collect()
    languages = sorted({r["lang"] for r in found})
    names = sorted({(r["size"], r["w"]) for r in found})
    index = {_mark(size, w): i for i, (size, w) in enumerate(names)}
    at = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((len(names), len(languages)))
    sizes = np.array([size for size, _ in names], int)
    for r in found:
        counts[index[_mark(r["size"], r["w"])], at[r["lang"]]] = r["n"]
    rows = np.zeros_like(counts)
    for size in range(LONGEST + 1):
        these = sizes == size
        part = counts[these] + 0.5
        rows[these] = np.log(part / part.sum(axis=0)) if these.any() else part
    return Model(languages, index, rows)


def evenly(sizes: list[int], total: int) -> float:
    """The most that each class may give so that all give ``total``; small ones give all."""
    left, room = float(total), float(total)
    for i, n in enumerate(sorted(sizes)):
        room = left / (len(sizes) - i)
        if n > room:
            return room
        left -= n
    return max(room, max(sizes, default=0))


def _mark(size: int, word: str) -> str:
    return word if size == 0 else f"{size}{word}"


class Predictor:
    def __init__(self, model: Model):
        self.model, self.known = model, len(model.index)
        self.rows = np.concatenate([model.rows, np.zeros((1024, len(model.languages)))])
        self.index, self.used = dict(model.index), self.known

    def _row(self, word: str) -> int:
        """Row of a word; an unseen one gets the mean of its longest known n-grams."""
        if self.used == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        row, padded = np.zeros(len(self.model.languages)), f" {word} "
        for size in range(LONGEST, 0, -1):
            grams = [padded[i:i + size] for i in range(len(padded) - size + 1)]
            hits = [self.model.index[m] for g in grams if (m := _mark(size, g)) in self.model.index]
            if hits:
                row = self.model.rows[hits].mean(axis=0)
                break
        self.rows[self.used] = row
        self.index[word] = self.used
        self.used += 1
        return self.used - 1

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if self.used - self.known > REMEMBERED:
            self.index, self.used = dict(self.model.index), self.known
        names, scores, index = [], [], self.index
        for text in texts:
            words = _LETTERS.findall(text.lower()) if text else []
            if not words or not self.model.languages or not any(c.isalpha() for c in text):
                names.append(UNKNOWN), scores.append(0.0)
                continue
            rows = np.array([r if (r := index.get(w)) is not None else self._row(w) for w in words])
            # digits cannot start a word here, so a word never meets an n-gram's mark
            total = self.rows[rows].sum(axis=0) / np.sqrt(len(words))
            chance = np.exp(total - total.max())
            best = int(chance.argmax())
            names.append(self.model.languages[best]), scores.append(float(chance[best] / chance.sum()))
        return names, scores


def identify_languages(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``lang_pred`` and ``score`` (columns of
    these names are replaced). Only the text is looked at.

    A word's evidence is its log frequency per language; a text's is the sum, divided
    by the root of its number of words, and ``score`` is the posterior of the best
    language (ties: first by name). Null texts, texts without a letter and an empty
    model give ``und`` with score 0. Rows are independent; no rows, no result.
    """
    ship(docs.sparkSession)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        predict = Predictor(shipped.value)
        for batch in batches:
            names, scores = predict(batch.columns[-1].to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())], schema.names)

    return docs.select(*carried(kept), F.col(text).alias("_text")).mapInArrow(run, schema)
