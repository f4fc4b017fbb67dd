"""Quality rules: counts of a text, and its distance from what its language looks like."""

from __future__ import annotations

import json
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.llm.common import carried, cut, given_back, let, text_of, words_of

#: Words of a language whose frequencies are compared.
COMMON_WORDS = 40
#: Counters a task keeps while it looks for them (any word above 1 in this number is found).
TRACKED_WORDS = 20_000
#: Texts below these lengths are too short for a verdict of the histogram.
LEAST_WORDS, LEAST_CHARS = 50, 200
#: Jensen-Shannon distances (base 2, 0 to 1) up to which a text is like its language.
MOST_WORD_DISTANCE, MOST_CLASS_DISTANCE = 0.48, 0.28
#: Plain words of a language that make up most of its texts, and the share of them,
#: measured by what its texts hold on average, below which a text is no prose.
KNOWN_WORDS, LEAST_KNOWN = 2_000, 0.5
#: Documents that pass the base rules a language must have to know its words.
LEAST_DOCUMENTS = 20
#: Signs that stand at the ends of words.
SIGNS = ".,;:!?'\"()[]{}<>/@_-#*$%&|=+~`^\\"

#: Character classes; lower-case letters and all else are the last bin.
CLASSES = {"upper": r"[^\p{Lu}]+", "digit": r"[^0-9]+", "symbol": r"[^#*$%&|<>]+", "mark": r"[^.,;:!?'\"()/@_\-]+"}
#: Most of any text is this; the classes are counted in what is left of it.
USUAL = r"[a-z\x20\x09-\x0D\xDF-\xFF]+"

REFERENCES = "array<struct<words: map<string, double>, other: double, classes: array<double>>>"
CLASS_BINS = len(CLASSES) + 2


def document_counts(text: Column, vocabulary: list[str], known: list[str] = ()) -> Column:
    """One struct a text: the base counts, its common words (lower case, sorted), how
    many of its words are ``known`` and its characters by class. Words are found once.

    ``n_repeat_words``: windows of three words are hashed; where all hashes of a text
    differ the count is 0, else equal ones meet by sorting, and the distinct positions
    they cover are counted: no step is worse than n log n in the text's length.
    """
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda column: F.length(column).cast("bigint")
    common = lambda words: F.sort_array(F.filter(F.transform(words, F.lower), lambda w: w.isin(vocabulary))) \
        if vocabulary else F.array().cast("array<string>")
    rare = lambda left: F.array(*[count(F.regexp_replace(left, p, "")) for p in CLASSES.values()])
    return let(words_of(text), lambda words: F.struct(
        F.size(words).cast("bigint").alias("n_words"),
        count(F.array_join(words, "")).alias("word_chars"),
        let(lines, lambda found: (F.size(found) - F.size(F.array_distinct(found))).cast("bigint")).alias("n_dup_lines"),
        _repeated(words).cast("bigint").alias("n_repeat_words"),
        common(words).alias("common"),
        (F.size(F.filter(words, lambda w: _plain(w).isin(known))) if known else F.lit(0)).cast("bigint").alias("n_known"),
        count(text).alias("chars"),
        let(F.regexp_replace(text, USUAL, ""), rare).alias("rare"),
    ))


def class_bins(counts: Column) -> Column:
    """Characters by class, white space next to last, the rest last."""
    rare = [counts["rare"][i] for i in range(len(CLASSES))]
    space = counts["chars"] - counts["word_chars"]
    return F.array(*rare, space, counts["word_chars"] - sum(rare[1:], rare[0]))


def _plain(word: Column) -> Column:
    """Lower case, without signs at the ends; empty if it is made of signs."""
    return F.lower(F.btrim(word, F.lit(SIGNS)))


def _failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _repeated(words: Column) -> Column:
    starts = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    return let(F.transform(starts, lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))), _covered)


def _covered(windows: Column) -> Column:
    def positions(placed: Column) -> Column:
        count = F.size(placed) - 1
        pairs = F.zip_with(F.slice(placed, 1, count), F.slice(placed, 2, count), lambda a, b: F.when(
            a["h"] == b["h"], F.array(a["at"], b["at"])).otherwise(F.array().cast("array<int>")))
        return F.flatten(pairs)

    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    covered = let(let(placed, positions), lambda at: F.size(F.array_distinct(F.concat(
        at, F.transform(at, lambda i: i + 1), F.transform(at, lambda i: i + 2)))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered)


def frequent_words(docs: DataFrame, text: str = "text", lang: str = "lang", known: bool = False) -> tuple[list[str], list[str]]:
    """Words that may be among the commonest of a language, and (if asked) its known words.

    A frequent-items sketch over all documents names twice as many of the first as are
    kept. The known words are plain (``_plain``) and come from a sketch over all
    documents that pass the base rules; a word that stands there
    once, or once in ``TRACKED_WORDS``, is none. What comes to the driver grows with the
    number of languages only.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    top = F.expr(f"approx_top_k(word, {2 * COMMON_WORDS}, {TRACKED_WORDS})").alias("top")
    if not known:
        spoken = rows.select(F.col(lang).alias("lang"), F.explode(words_of(F.lower(text))).alias("word"))
        return sorted({x["item"] for r in spoken.groupBy("lang").agg(top).collect() for x in r["top"]}), []
    split = rows.select(F.col(lang).alias("lang"), let(words_of(F.col(text)), lambda words: F.struct(
        words.alias("words"), (~_failed(F.size(words), _repeated(words))).alias("passed"))).alias("s"))
    spoken = split.select("lang", F.col("s.passed").alias("passed"), F.explode("s.words").alias("w")).select(
        "lang", F.lower("w").alias("word"), F.when(F.col("passed"), _plain(F.col("w"))).alias("plain"))
    plain = F.expr(f"approx_top_k(plain, {KNOWN_WORDS}, {TRACKED_WORDS}) FILTER (WHERE plain <> '')").alias("plain")
    sketched = spoken.groupBy("lang").agg(top, plain, F.count("plain").alias("n")).collect()
    return (sorted({x["item"] for r in sketched for x in r["top"]}),
            sorted({x["item"] for r in sketched for x in r["plain"] or () if x["count"] > max(1, r["n"] / TRACKED_WORDS)}))


def language_references(counted: DataFrame, lang: str = "lang", counts: str = "_counts") -> list[dict]:
    """Common words and character classes of each language, exactly, over all its
    documents, and the share of known words in those that pass the base rules (null
    for fewer than ``LEAST_DOCUMENTS``); ``counted`` holds their ``document_counts``."""
    rows = counted.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(counts).alias("c"))
    passed = ~_failed(F.col("c.n_words"), F.col("c.n_repeat_words"))
    words = rows.select("lang", F.explode("c.common").alias("word")).groupBy("lang", "word").agg(
        F.count(F.lit(1)).alias("n"))
    commonest = W.partitionBy("lang").orderBy(F.desc("n"), "word")
    words = words.withColumn("place", F.row_number().over(commonest)).where(F.col("place") <= COMMON_WORDS)
    totals = rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("c.n_words").alias("words"), F.count_if(passed).alias("passed"),
        F.avg(F.when(passed, F.col("c.n_known") / F.col("c.n_words"))).alias("known"),
        *[F.sum(class_bins(F.col("c"))[i]).alias(f"c{i}") for i in range(CLASS_BINS)])
    found: dict[str, list] = {}
    for r in words.collect():
        found.setdefault(r["lang"], []).append((-r["n"], r["word"]))
    out = []
    for r in totals.orderBy(F.desc("docs"), "lang").collect():
        sums = [r[f"c{i}"] for i in range(CLASS_BINS)]
        if r["lang"] not in found or not sum(sums):
            continue
        shares = {w: -n / r["words"] for n, w in sorted(found[r["lang"]])}
        out.append({"lang": r["lang"], "words": shares, "other": 1 - sum(shares.values()),
                    "classes": [n / sum(sums) for n in sums],
                    "known": r["known"] if r["passed"] >= LEAST_DOCUMENTS else None})
    return out


def _parts(p: Column, q: Column) -> Column:
    """A bin's part of twice the Jensen-Shannon divergence."""
    half = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    return half(p, q) + half(q, p)


def _root(divergence: Column) -> Column:
    return F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), divergence / 2)))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def class_distance(counts: Column, references: Column) -> Column:
    """Distance from the nearest language by character classes."""
    shares = F.transform(class_bins(counts), lambda n: n / counts["chars"])
    return let(shares, lambda p: F.array_min(F.transform(
        references, lambda r: _root(_total(F.zip_with(p, r["classes"], _parts))))))


def word_distance(counts: Column, references: Column) -> Column:
    """Distance from the nearest language by its common words, the rest being one bin."""
    common = counts["common"]

    def run(word, i, each):
        """A sorted word's run ends where the next one's begins."""
        after = F.when(i + 1 < F.size(each), F.array_position(common, F.get(each, i + 1))).otherwise(
            F.size(common).cast("bigint") + 1)
        share = (after - F.array_position(common, word)) / counts["n_words"]
        return F.struct(word.alias("word"), share.alias("p"))

    def against(r: Column, runs: Column) -> Column:
        """Words that a language does not list belong to its other words."""
        met = F.transform(runs, lambda x: F.struct(x["p"].alias("p"), F.element_at(r["words"], x["word"]).alias("q")))

        def distance(listed: Column) -> Column:
            rest = 1 - F.aggregate(listed, F.lit(0.0), lambda a, x: a + x["p"])
            unmet = 1 - r["other"] - F.aggregate(listed, F.lit(0.0), lambda a, x: a + x["q"])
            return _root(_total(F.transform(listed, lambda x: _parts(x["p"], x["q"]))) + _parts(rest, r["other"]) + unmet)

        return let(F.filter(met, lambda x: x["q"].isNotNull()), distance)

    found = let(F.array_distinct(common), lambda each: F.transform(each, lambda word, i: run(word, i, each)))
    return let(found, lambda runs: F.array_min(F.transform(references, lambda r: against(r, runs))))


def known_share(counts: Column, lang: Column, references: list[dict]) -> Column:
    """Share of known words, as a multiple of that of the text's language (of the
    language with the smallest, where its own has none); null where none has any."""
    typical = {r["lang"]: r["known"] for r in references if r["known"]}
    if not typical:
        return F.lit(None).cast("double")
    own = F.element_at(F.create_map(*[F.lit(x) for pair in typical.items() for x in pair]), lang)
    return counts["n_known"] / counts["n_words"] / F.coalesce(own, F.lit(min(typical.values())))


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", keep: list[str] | None = None,
                  most_word_distance: float = MOST_WORD_DISTANCE,
                  most_class_distance: float = MOST_CLASS_DISTANCE, least_known: float | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``quality``, a struct of the counts,
    ``word_distance``, ``class_distance``, ``known_share``, ``base_failed`` and
    ``kept``; a column of that name in ``docs`` is replaced.

    ``base_failed``: under 50 words, or more than half of the words in repeated
    windows. Otherwise a text is kept unless one of its histograms lies farther from
    every language than allowed. With ``least_known`` it must also hold that share of
    the known words which its language's texts hold on average: the distances reject
    a text without any common word only where such texts are frequent, this share
    however rare they are. Texts below ``LEAST_WORDS`` or ``LEAST_CHARS``, and all
    where no language is known (an empty table), get neither verdict: distances and
    share are null. The share is null, too, where it is not asked for. Every language
    has references, however few its documents: a text is compared with all of them.

    Null text counts as empty: no words, so failed. Repeated rows are judged alike.
    The texts are read twice (frequent words; all counts), and the counts are written,
    with the kept columns, to the shared folder: the references come from that table.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != "quality"]
    counted = cut(docs.select(*carried(kept), F.col(lang).alias("_lang"), document_counts(
        text_of(text), *frequent_words(docs, text, lang, least_known is not None)).alias("_counts")), "quality")
    references = language_references(counted, "_lang")
    known = F.from_json(F.lit(json.dumps([{k: r[k] for k in ("words", "other", "classes")} for r in references])),
                        REFERENCES)
    counts = F.col("_counts")
    long = (counts["n_words"] >= LEAST_WORDS) & (counts["chars"] >= LEAST_CHARS) & F.lit(bool(references))
    measured = counted.withColumns({
        "_words": F.when(long, word_distance(counts, known)), "_classes": F.when(long, class_distance(counts, known)),
        "_known": F.when(long, known_share(counts, F.col("_lang"), references))})
    failed = _failed(counts["n_words"], counts["n_repeat_words"])
    far = (F.coalesce(F.col("_words") > most_word_distance, F.lit(False))
           | F.coalesce(F.col("_classes") > most_class_distance, F.lit(False))
           | F.coalesce(F.col("_known") < F.lit(least_known).cast("double"), F.lit(False)))
    symbols = counts["rare"][list(CLASSES).index("symbol")]
    return measured.select(*given_back(kept), F.struct(
        counts["n_words"].alias("n_words"), counts["word_chars"].alias("word_chars"), symbols.alias("n_symbols"),
        counts["n_dup_lines"].alias("n_dup_lines"), counts["n_repeat_words"].alias("n_repeat_words"),
        F.col("_words").alias("word_distance"), F.col("_classes").alias("class_distance"), F.col("_known").alias("known_share"),
        failed.alias("base_failed"), (~failed & ~far).alias("kept")).alias("quality"))
