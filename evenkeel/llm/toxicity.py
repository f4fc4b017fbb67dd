"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.llm.common import carried, cut, ship
from evenkeel.llm.language import evenly

#: The lexicon and its scale are learned from about this many labelled documents: half of
#: them toxic and half not, or all of a label that has fewer.
SAMPLE_DOCUMENTS = 20_000
#: Terms considered (those in most toxic documents), and how often a term must be seen.
CANDIDATES = 50_000
LEAST_SEEN = 6
#: How much oftener, a word, a term must occur in toxic documents than in others.
LEAST_ODDS = 20.0
#: Occurrences that count in one document.
OCCURRENCES = 10
STEMS = range(4, 9)

# fixed values: characters that stand for others; look-alikes fold to one of their class
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "к": "k",
    "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v",
    "τ": "t", "υ": "u", "χ": "x", "0": "o", "1": "i", "l": "i", "|": "i", "!": "i", "3": "e", "4": "a", "@": "a",
    "5": "s", "$": "s", "7": "t", "8": "b", "9": "g", "ß": "ss", "ı": "i",
}
_FOLD = str.maketrans(HOMOGLYPHS)
_PLAIN = str.maketrans({k: v for k, v in HOMOGLYPHS.items() if k.isascii()})
_MARKS = re.compile("[̀-ͯ]")
#: A word has a letter in it: digits and signs alone stand for nothing.
_WORD = re.compile(r"[\w@$|!]*[^\W\d_][\w@$|!]*")
_SIGNS = "|!"


def folded(text: str) -> list[str]:
    """Words in lower case, without accents, look-alikes and digits replaced."""
    words = (w.rstrip(_SIGNS) for w in _WORD.findall(text.lower()))
    joined = " ".join(words)
    if joined.isascii():
        return joined.translate(_PLAIN).split(" ") if joined else []
    return _MARKS.sub("", unicodedata.normalize("NFKD", joined)).translate(_FOLD).split(" ")


def terms_of(words: list[str]) -> Counter:
    """What a lexicon may hold, with its occurrences: whole words (between spaces) and
    beginnings of words."""
    found: Counter = Counter()
    for w, n in Counter(words).items():
        found[f" {w} "] += n
        for size in STEMS:
            if len(w) >= size:
                found[f" {w[:size]}"] += n
    return found


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    #: phrases in which a term is harmless, with the weight they take back
    exceptions: dict[str, float] = field(default_factory=dict)
    #: logistic scale: constant, weight found, weight found a thousand words, largest weight
    scale: tuple[float, ...] = (-3.0, 0.0, 0.0, 0.0)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.scale, self.lexicon = lexicon.scale, lexicon
        self.words = ahocorasick.Automaton()
        for term, weight in lexicon.weights.items():
            self.words.add_word(term, (len(term), weight, term))
        for phrase, weight in lexicon.exceptions.items():
            self.words.add_word(phrase, (0, -weight, phrase))
        self.any = bool(lexicon.weights)
        self.words.make_automaton()

    def hits(self, words: list[str]) -> tuple[float, list[tuple[int, str]]]:
        """Total weight, and the longest term that starts at each place."""
        if not self.any or not words:
            return 0.0, []
        best: dict[int, tuple[int, float, str]] = {}
        total = 0.0
        for last, (size, weight, term) in self.words.iter(f" {' '.join(words)} "):
            if not size:
                total += weight
            elif (start := last + 1 - size) not in best or best[start][0] < size:
                best[start] = (size, weight, term)
        return max(0.0, total + sum(w for _, w, _ in best.values())), [(at, b[2]) for at, b in sorted(best.items())]

    def features(self, text: str | None) -> tuple[float, float, float]:
        words = folded(text) if text else []
        total, terms = self.hits(words)
        if not total:
            return 0.0, 0.0, 0.0
        largest = max(self.lexicon.weights[t] for _, t in terms)
        return math.log1p(total), math.log1p(1000 * total / len(words)), largest

    def score(self, text: str | None) -> float:
        x = self.scale[0] + sum(w * f for w, f in zip(self.scale[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def fit_lexicon(docs: DataFrame, labels: DataFrame, identifier: str = "doc_id", text: str = "text",
                label: str = "toxic", sample: int = SAMPLE_DOCUMENTS) -> Lexicon:
    """Learn terms, weights, exceptions and scale from a hash sample of labelled rows,
    drawn by label; the scale weighs them back to their shares in all labels.

    Weights are log odds of documents. A beginning of words stands in the lexicon only
    where no longer term says the same. An exception is a term with the word before or
    behind it that harmless documents hold again and again and toxic ones never. Null
    labels and texts are left out; of repeated labels the largest counts. Without both
    kinds of labels nothing is learned. All that is collected is bounded by the sample
    and ``CANDIDATES``.
    """
    ship(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(identifier).isNotNull()).groupBy(identifier).agg(
        F.max(label).cast("int").alias("_toxic"))
    labelled = {bool(r["toxic"]): r["n"] for r in known.groupBy((F.col("_toxic") == 1).alias("toxic")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    room = evenly(list(labelled.values()), sample)
    share = {kind: min(1.0, room / max(1, labelled.get(kind, 0))) for kind in (False, True)}
    upto = lambda kind: F.lit(int(share[kind] * (1 << 20)) + 1)
    chosen = known.where(F.pmod(F.xxhash64(identifier), F.lit(1 << 20)) < F.when(
        F.col("_toxic") == 1, upto(True)).otherwise(upto(False)))
    # bounded by the sample: a few hundred kilobytes; of equal texts one teaches
    texts = docs.select(F.col(identifier).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")
    rows = cut(texts.join(F.broadcast(chosen.withColumnRenamed(identifier, "id")), "id").groupBy("text").agg(
        F.max("_toxic").alias("_toxic")), "labelled")  # written once, read by each step

    def counted(per_document, wanted: int, least: int) -> dict[str, int]:
        parts = rows.where(F.col("_toxic") == wanted).select("text").mapInArrow(
            _counter(per_document), "term string, docs bigint, n bigint")
        found = parts.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).where(F.col("docs") >= least)
        return {r["term"]: (r["docs"], r["n"]) for r in found.orderBy(F.desc("docs"), "term").limit(CANDIDATES).collect()}

    spread = rows.groupBy("_toxic").agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).collect()
    sizes = {r["_toxic"]: r["n"] for r in spread}
    if not sizes.get(1) or not sizes.get(0):
        return Lexicon()
    bad = counted(terms_of, 1, LEAST_SEEN)
    names = frozenset(bad)
    good = counted(lambda words: {t: n for t, n in terms_of(words).items() if t in names}, 0, 1)
    rate = lambda n, kind: (n + 0.5) / (sizes[kind] + 1)
    odds = {t: rate(n, 1) / rate(good.get(t, (0, 0))[1], 0) for t, (_, n) in bad.items()}
    said = _said_longer({t: docs for t, (docs, _) in bad.items()})
    lexicon = Lexicon({t: math.log(odds[t]) for t in sorted(bad.keys() - said) if odds[t] >= LEAST_ODDS})

    phrases = lambda words: dict.fromkeys(_phrases(words, _matcher(lexicon)), 1)
    harmless, spoken = counted(phrases, 0, LEAST_SEEN), counted(phrases, 1, 1)
    lexicon = Lexicon(lexicon.weights, {p: _weight(p, lexicon.weights) for p in harmless if p not in spoken})
    measured = rows.select("text", "_toxic").mapInArrow(
        _measure(lexicon), "a double, b double, c double, toxic int").groupBy("a", "b", "c", "toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()
    lexicon.scale = _logistic(np.array([[1.0, r["a"], r["b"], r["c"]] for r in measured]),
                              np.array([float(r["toxic"]) for r in measured]), np.array([r["n"] / share[r["toxic"] == 1] for r in measured]))
    return lexicon


def _said_longer(terms: dict[str, int]) -> set[str]:
    """Beginnings of words whose documents (nearly) all hold one longer term."""
    said = set()
    for term, n in terms.items():
        for back in (1, 2):
            stem = term[:-back]
            if n >= 0.95 * terms.get(stem, n + n):
                said.add(stem)
    return said


def _phrases(words: list[str], matcher: Matcher) -> set[str]:
    text, found = f" {' '.join(words)} ", set()
    for at, _ in matcher.hits(words)[1]:
        end = text.index(" ", at + 1)
        before, behind = text.rfind(" ", 0, at), text.find(" ", end + 1)
        if before >= 0:
            found.add(text[before:end + 1])
        if behind >= 0:
            found.add(text[at:behind + 1])
    return found


def _weight(phrase: str, weights: dict[str, float]) -> float:
    words = phrase.split()
    return max((w for t in terms_of(words) if (w := weights.get(t))), default=0.0)


_MATCHERS: dict[int, Matcher] = {}


def _matcher(lexicon: Lexicon) -> Matcher:
    """One automaton a worker for the lexicon at hand."""
    if id(lexicon) not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[id(lexicon)] = Matcher(lexicon)
    return _MATCHERS[id(lexicon)]


def _counter(per_document):
    """Documents and occurrences of each term, as partial sums."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        docs, total = Counter(), Counter()

        def sums():
            return pa.RecordBatch.from_pydict({
                "term": pa.array(list(docs), pa.string()), "docs": pa.array(list(docs.values()), pa.int64()),
                "n": pa.array([total[t] for t in docs], pa.int64())})

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = per_document(folded(text))
                docs.update(found.keys())
                for t, n in found.items():
                    total[t] += min(n, OCCURRENCES)
                if len(docs) > 300_000:  # handed on: the tables stay small
                    yield sums()
                    docs.clear(), total.clear()
        yield sums()
    return run


def _measure(lexicon: Lexicon):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        matcher = Matcher(lexicon)
        for batch in batches:
            pairs = [matcher.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                **{k: pa.array([p[i] for p in pairs], pa.float64()) for i, k in enumerate("abc")},
                "toxic": batch.column(1).cast(pa.int32())})
    return run


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Newton steps for a ridge-penalised logistic regression."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + penalty @ w
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty, gradient)
        w = w - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``score`` in [0, 1] (a column of that
    name is replaced): logistic in the weight of the terms found, less exceptions, and
    in that weight a thousand words. Only the text is looked at. Null and empty texts
    score as texts without a term. Rows are independent; no rows, no result.
    """
    ship(docs.sparkSession)
    kept = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    shipped = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        matcher = Matcher(shipped.value)
        for batch in batches:
            scores = [matcher.score(t) for t in batch.columns[-1].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], schema.names)

    return docs.select(*carried(kept), F.col(text).alias("_text")).mapInArrow(run, schema)
