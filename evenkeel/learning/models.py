"""Breach-risk models on Spark ML: one-hot with rare levels folded, trees, baselines."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    Imputer, OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import nan_to_null, probability_label
from evenkeel.learning.evaluation import classification_metrics
from evenkeel.learning.forests import Scorer, fit_forest
from evenkeel.operators.joins import rate_lookup
from evenkeel.operators.ordered import exact_quantiles
from evenkeel.plans.features import cutoff_split
from evenkeel.session import durable, shared_path

RARE = "_rare_"
MISSING = "_missing_"
#: Memory for the statistics of tree nodes that one pass over the rows splits.
NODE_MEMORY_MB = 1024
#: Rows of a task of tree fits, where that makes more tasks than cores.
ROWS_PER_TASK = 1_000_000


@dataclass
class BreachModel:
    """A fitted pipeline with the category levels it keeps."""

    pipeline: PipelineModel
    kept: dict[str, list[str]]
    categories: Sequence[str]
    numbers: Sequence[str]
    name: str
    assembled: str = "_features"
    options: dict = field(default_factory=dict)
    #: Of a forest just fitted: scores whole batches by tree, the same as its pipeline does row by row.
    scorer: Scorer | None = None

    def transform(self, df: DataFrame, output: str = "breach_probability") -> DataFrame:
        """Probability of the positive class as a plain column."""
        rows = _prepared(df, self.kept, self.categories, self.numbers)
        if self.scorer:
            ready = PipelineModel(self.pipeline.stages[:-1]).transform(rows)
            scored = ready.withColumn(output, self.scorer.score(_forest_values(self.categories)))
        else:
            scored = self.pipeline.transform(rows).withColumn(output, F.get(vector_to_array("_probability"), 1))
        return scored.select(*df.columns, output)

    def parts(self, df: DataFrame, features: Sequence[str]) -> DataFrame:
        """Array ``_parts``: what all else and then each of ``features`` adds to the logistic
        model's margin. The probability is the logistic function of their sum."""
        if self.name != "logistic":
            raise ValueError(f"a {self.name} model's score is no sum over features")
        fitted, labels = self.pipeline.stages[-1], self.pipeline.stages[0].labelsArray
        weights, adds, at = [float(w) for w in fitted.coefficients], {}, 0
        for c, known in zip(self.categories, labels):
            slots = weights[at:at + len(known) + 1]  # the last is for levels never seen
            adds[c] = F.get(F.array(*[F.lit(w) for w in slots]), F.col(f"_idx_{c}").cast("int"))
            at += len(slots)
        adds.update({c: F.col(f"_imp_{c}") * F.lit(w) for c, w in zip(self.numbers, weights[at:])})
        ready = PipelineModel(self.pipeline.stages[:-1]).transform(_prepared(df, self.kept, self.categories, self.numbers))
        rest = reduce(lambda a, b: a + b, [adds[c] for c in adds if c not in features], F.lit(float(fitted.intercept)))
        return ready.select(*df.columns, F.array(rest, *[adds.get(f, F.lit(0.0)) for f in features]).alias("_parts"))

    def impurity_importance(self, n: int = 20) -> DataFrame:
        """Importance per encoded level or number, from the trees' split gains."""
        gains = self.pipeline.stages[-1].featureImportances.toArray()
        values = [(name, float(gain)) for name, gain in zip(self.options["names"], gains)]
        table = SparkSession.getActiveSession().createDataFrame(values, "feature STRING, importance DOUBLE")
        return table.orderBy(F.desc("importance"), "feature").limit(n)


def _level(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(MISSING))


def _number(c: str) -> Column:
    # not-a-number is missing here, and ends with it: no model sees either
    return nan_to_null(F.col(c).cast("double"))


def _forest_values(categories: Sequence[str]) -> Column:
    return F.concat(F.array(*[F.col(f"_idx_{c}") for c in categories]), vector_to_array("_scaled"))


@dataclass
class _Counts:
    """What one pass over the training rows tells: rows, rows of each level kept, and of
    each number its filled rows, least and largest value."""

    rows: int
    levels: dict[str, dict[str, int]]
    numbers: dict[str, tuple[int, float | None, float | None]]

    @property
    def kept(self) -> dict[str, list[str]]:
        return {c: list(found) for c, found in self.levels.items()}

    def labels(self, c: str) -> dict[str, int]:
        """Rows of each label after folding."""
        found = dict(self.levels[c])
        rest = self.rows - sum(found.values())
        if rest:
            found[RARE] = found.get(RARE, 0) + rest
        return found

    def indexer(self, spark: SparkSession, categories: Sequence[str]) -> StringIndexerModel:
        """The labels' places, fitted on a table of the labels, not on the rows."""
        labels = {f"_cat_{c}": list(self.labels(c)) for c in categories}
        table = spark.range(0, max(map(len, labels.values())), 1, 1).select(*[
            F.element_at(F.lit(x), F.least(F.col("id") + 1, F.lit(len(x))).cast("int")).alias(c) for c, x in labels.items()])
        return StringIndexer(inputCols=list(labels), outputCols=[f"_idx_{c}" for c in categories], handleInvalid="keep",
                             stringOrderType="alphabetAsc").fit(table)

    def varies(self, c: str) -> bool:
        """Whether a number, its median in its gaps, is not constant."""
        _, low, high = self.numbers[c]
        return math.isfinite(low) and math.isfinite(high) and low < high

    def gaps(self, c: str) -> bool:
        return self.numbers[c][0] < self.rows


def _counted(train: DataFrame, categories: Sequence[str], numbers: Sequence[str], min_frequency: int) -> _Counts:
    """All categories and numbers in one pass: rows meet by their levels first, and only
    such totals are counted per level.

    The levels with at least ``min_frequency`` rows are the model's vocabulary, bounded by
    rows / min_frequency; one-hot encoding brings it to the driver anyway.
    """
    facts = [[F.count(_number(c)), F.min(_number(c)), F.max(_number(c))] for c in numbers]
    totals = train.groupBy(*[_level(c).alias(f"_level{i}") for i, c in enumerate(categories)]).agg(
        F.count(F.lit(1)).alias("_n"), *[f.alias(f"_{k}{i}") for i, fs in enumerate(facts) for k, f in zip("flh", fs)])
    names = [F.struct(F.lit(i).alias("_at"), F.col(f"_level{i}").alias("_level")) for i in range(len(categories))]
    whole = F.struct(F.lit(None).cast("int").alias("_at"), F.lit(None).cast("string").alias("_level"))
    merge = [f(f"_{k}{i}").alias(f"_{k}{i}") for i in range(len(numbers)) for k, f in zip("flh", (F.sum, F.min, F.max))]
    long = totals.select(F.inline(F.array(whole, *names)), "_n", *[f"_{k}{i}" for i in range(len(numbers)) for k in "flh"])
    found = long.groupBy("_at", "_level").agg(F.sum("_n").alias("_n"), *merge).where(
        F.col("_at").isNull() | (F.col("_n") >= min_frequency)).collect()
    levels: dict[str, dict[str, int]] = {c: {} for c in categories}
    for row in sorted((r for r in found if r["_at"] is not None), key=lambda r: r["_level"].encode()):
        levels[categories[row["_at"]]][row["_level"]] = row["_n"]
    all_rows = next((r for r in found if r["_at"] is None), None)
    if all_rows is None:
        return _Counts(0, levels, {c: (0, None, None) for c in numbers})
    return _Counts(all_rows["_n"], levels, {c: tuple(all_rows[f"_{k}{i}"] for k in "flh") for i, c in enumerate(numbers)})


def kept_levels(train: DataFrame, categories: Sequence[str], min_frequency: int) -> dict[str, list[str]]:
    """Levels with at least ``min_frequency`` training rows; the rest fold into one."""
    return _counted(train, categories, [], min_frequency).kept


def _prepared(df: DataFrame, kept: Mapping[str, list[str]], categories: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    folded = {f"_cat_{c}": F.when(_level(c).isin(kept[c]), _level(c)).otherwise(RARE) if kept[c] else F.lit(RARE)
              for c in categories}
    plain = {f"_num_{c}": _number(c) for c in numbers}
    # trees cannot route a missing value: a flag keeps that it was missing
    flags = {f"_gap_{c}": _number(c).isNull().cast("double") for c in numbers}
    return df.withColumns({**folded, **plain, **flags})


def _features(counts: _Counts, spark: SparkSession, categories: Sequence[str], numbers: Sequence[str],
              kind: str) -> tuple[list, list[str]]:
    """Stages up to ``_features``, and the names of its slots. Labels and constant slots are known
    from the counts, so that only medians and scales are still learned from the rows.

    The boosted model has flags of gaps, and no slot that is constant in training.
    """
    indexer, boosted = counts.indexer(spark, categories), kind == "boosted"
    known = dict(zip(categories, indexer.labelsArray))
    hot = [c for c in categories if len(known[c]) > 1 or not boosted]
    plain = [c for c in numbers if counts.varies(c) or not boosted]
    flags = [c for c in numbers if counts.gaps(c)] if boosted else []
    if not (hot or plain or flags):
        plain = list(numbers)
    # the last slot of a category is for values never seen
    names = [f"{c}={v}" for c in hot for v in [*known[c], *([] if boosted else ["<unseen>"])]]
    names += [*plain, *(f"{c} missing" for c in flags)]
    stages: list = [indexer]
    if hot:
        stages.append(OneHotEncoder(inputCols=[f"_idx_{c}" for c in hot], outputCols=[f"_hot_{c}" for c in hot],
                                    handleInvalid="error" if boosted else "keep", dropLast=True))
    stages.append(Imputer(inputCols=[f"_num_{c}" for c in numbers], outputCols=[f"_imp_{c}" for c in numbers], strategy="median"))
    used = [f"_imp_{c}" for c in plain]
    if kind == "forest":
        stages.append(VectorAssembler(inputCols=used, outputCol="_numbers"))
        stages.append(StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True))
        used = ["_scaled"]
    inputs = [*[f"_hot_{c}" for c in hot], *used, *[f"_gap_{c}" for c in flags]]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_features"))
    return stages, names


def with_class_weights(train: DataFrame, label: str, name: str = "_weight") -> DataFrame:
    """Weight of a row: n / (2 · rows of its class)."""
    y = F.col(label).cast("double")
    totals = train.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("p"))
    n, p = totals.select("n").scalar(), totals.select("p").scalar()
    return train.withColumn(name, F.when(y == 1.0, n / (p * 2.0)).otherwise(n / ((n - p) * 2.0)))


def fit_breach_model(train: DataFrame, kind: str, categories: Sequence[str], numbers: Sequence[str], label: str,
                     min_frequency: int = 20, trees: int | None = None, depth: int | None = None, seed: int = 42,
                     validation_fraction: float = 0.1, identifier: str | None = None) -> BreachModel:
    """Fit ``boosted``, ``forest`` or ``logistic`` on training rows.

    Boosting stops early on a hash-chosen validation share; the forest weights the
    classes; the logistic model standardises inside the solver.
    """
    counts = _counted(train, categories, numbers, min_frequency)
    kept = counts.kept
    # a column without a single value has no median to fill it with
    numbers = [c for c in numbers if counts.numbers[c][0]]
    data = _prepared(train, kept, categories, numbers).withColumn("_label", F.col(label).cast("double"))
    stages, names = _features(counts, train.sparkSession, categories, numbers, kind)
    common = {"featuresCol": "_features", "labelCol": "_label", "predictionCol": "_prediction"}
    if kind == "boosted":
        data = data.withColumn("_validate", F.pmod(F.xxhash64(identifier or F.struct(*categories, *numbers)), F.lit(1000))
                               < int(1000 * validation_fraction))
        model = GBTClassifier(maxIter=trees or 400, maxDepth=depth or 6, stepSize=0.08, seed=seed,
                              validationIndicatorCol="_validate", maxMemoryInMB=NODE_MEMORY_MB, **common)
    elif kind == "forest":
        data = with_class_weights(data, "_label")
        model = RandomForestClassifier(numTrees=trees or 300, maxDepth=depth or 12, minInstancesPerNode=20, seed=seed,
                                       weightCol="_weight", maxMemoryInMB=NODE_MEMORY_MB,
                                       # where a row is in each tree is kept, not walked from the root in every pass
                                       cacheNodeIds=True, **common)
    elif kind == "logistic":
        model = LogisticRegression(maxIter=1000 if trees is None else trees, **common)
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    model = model.setProbabilityCol("_probability").setRawPredictionCol("_raw")
    # features are worked out once, over all cores, and read by every pass of the fit
    prepared = Pipeline(stages=stages).fit(data)
    ready = prepared.transform(data)
    if kind == "forest":
        # what the slots are made from, which is a byte a column once it is binned
        ready = ready.select("_label", "_weight", _forest_values(categories).alias("_values"))
    else:
        ready = ready.select("_label", "_features", *(c for c in ("_validate",) if c in data.columns))
    if kind != "logistic":
        # every task of a pass sends the statistics of all nodes: more tasks only send more
        tasks = max(data.sparkSession.sparkContext.defaultParallelism, math.ceil(counts.rows / ROWS_PER_TASK))
        given = ready.rdd.getNumPartitions()
        ready = ready.repartition(tasks) if given < tasks else ready.coalesce(tasks)
    if kind == "forest":
        levels = [len(x) for x in prepared.stages[0].labelsArray]
        last, scorer = fit_forest(durable(ready), model, levels, len(numbers))
    else:
        last = _without_summary(model.fit(durable(ready)), data.sparkSession)
    fitted = PipelineModel([*prepared.stages, last])
    return BreachModel(fitted, kept, categories, numbers, kind, options={"names": names}, scorer=scorer if kind == "forest" else None)


def _without_summary(model, spark: SparkSession):
    """The model without its training summary, which holds the session: a session that
    has observed a query cannot travel to tasks, and the model's functions must."""
    if not getattr(model, "hasSummary", False):
        return model
    path = shared_path(spark, "fitted")
    model.write().save(path)
    return type(model).load(path)


# ------------------------------------------------------------------ artifacts
def save_model(model: BreachModel, path: str) -> str:
    """Write the fitted pipeline, and beside it the levels, columns and names it needs."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    facts = {"kept": model.kept, "categories": list(model.categories), "numbers": list(model.numbers), "name": model.name,
             "assembled": model.assembled, "options": model.options}
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(facts),)], "value STRING").coalesce(1).write.mode("overwrite").text(f"{path}/facts")
    return path


def load_model(path: str) -> BreachModel:
    """The model that ``save_model`` wrote; its scores are the same."""
    facts = json.loads(SparkSession.getActiveSession().read.text(f"{path}/facts").first()["value"])
    return BreachModel(PipelineModel.load(f"{path}/pipeline"), **facts)


# ------------------------------------------------------------------ baselines
def majority_rate(train: DataFrame, test: DataFrame, label: str, name: str = "p") -> DataFrame:
    return test.withColumn(name, train.agg(F.avg(F.col(label).cast("double"))).scalar())


def priority_rate(train: DataFrame, test: DataFrame, label: str, level: str = "priority_id_str", name: str = "p") -> DataFrame:
    return rate_lookup(train, test, level, label, name)


# ------------------------------------------------------------------ segments
def fit_segments(df: DataFrame, segment: str, cutoffs: Mapping[str, str], categories: Sequence[str], numbers: Sequence[str],
                 label: str, timestamp: str, kinds: Sequence[str] = ("forest", "boosted"),
                 **options) -> tuple[dict[str, BreachModel], DataFrame]:
    """Per segment: fit each kind, keep the one with the higher AUC after the cutoff.

    The segments are configured, so few; their fits run side by side, each a series of
    small distributed jobs, and the outcome does not depend on which ends first.
    """
    splits = {}
    for name, cutoff in cutoffs.items():
        splits[name] = cutoff_split(df.where(F.col(segment) == name), F.lit(cutoff).cast("timestamp"), timestamp)

    def fit(job: tuple[str, str]) -> tuple[BreachModel, float | None]:
        train, test = splits[job[0]]
        model = fit_breach_model(train, job[1], categories, numbers, label, **options)
        return model, classification_metrics(scored_once(model, test, "p"), "p", label).first()["roc_auc"]

    jobs = [(name, kind) for name in cutoffs for kind in kinds]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        results = list(pool.map(inheritable_thread_target(df.sparkSession)(fit), jobs))
    winners: dict[str, BreachModel] = {}
    best: dict[str, float] = {}
    rows = []
    for (name, kind), (model, auc) in zip(jobs, results):
        rows.append((name, kind, auc, cutoffs[name]))
        if (auc or 0.0) > best.get(name, -1.0):
            best[name], winners[name] = auc or 0.0, model
    table = df.sparkSession.createDataFrame(rows, "segment STRING, model STRING, roc_auc DOUBLE, test_cutoff STRING")
    return winners, table


def score_routed(df: DataFrame, segment: str, models: Mapping[str, BreachModel], output: str = "risk_prob") -> DataFrame:
    """Score each row with its segment's model; others get null and "no model"."""
    none = df.where(F.coalesce(~F.col(segment).isin(*models), F.lit(True)))
    parts = [none.withColumns({output: F.lit(None).cast("double"), "model_used": F.lit(None).cast("string")})]
    for name, model in models.items():
        part = model.transform(df.where(F.col(segment) == name), output)
        parts.append(part.withColumn("model_used", F.lit(f"model_{name}")))
    scored = reduce(lambda a, b: a.unionByName(b), parts)
    return scored.withColumn("risk_label", probability_label(output))


def scored_once(model: BreachModel, df: DataFrame, output: str = "breach_probability") -> DataFrame:
    """Scores in the checkpoint folder, for the several metrics that read them."""
    return durable(model.transform(df, output))


# ------------------------------------------------------------------ scaling
def robust_scaled(df: DataFrame, columns: Sequence[str], output: str = "scaled") -> DataFrame:
    """Median/IQR scaling of complete rows, exact: the quartiles of all columns come from
    one pass that counts the values of each column. A column without spread gives 0."""
    complete = df.dropna(subset=list(columns))
    values = complete.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_of")) for c in columns])))
    found = exact_quantiles(values, "_of", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, ["_column"], few_groups=True)
    table = found.agg(F.map_from_entries(F.collect_list(F.struct("_column", F.struct("q1", "q2", "q3"))))
                      .alias("q")).scalar()

    def scaled(c: str):
        q = F.element_at(table, F.lit(c))
        spread = q["q3"] - q["q1"]
        return F.when(spread == 0, 0.0).otherwise((F.col(c).cast("double") - q["q2"]) / spread)

    return complete.withColumn(output, F.array(*[scaled(c) for c in columns]))


def standard_scaled(df: DataFrame, columns: Sequence[str], output: str = "scaled") -> DataFrame:
    assembler = VectorAssembler(inputCols=list(columns), outputCol="_raw_vector", handleInvalid="skip")
    scaler = StandardScaler(inputCol="_raw_vector", outputCol="_scaled_vector", withMean=True)
    data = assembler.transform(df)
    scaled = scaler.fit(data).transform(data)
    return scaled.withColumn(output, vector_to_array("_scaled_vector")).drop("_raw_vector", "_scaled_vector")


def varying_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Variance per numeric column and whether it is above zero."""
    row = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in columns])
    return row.unpivot([], list(columns), "column_name", "variance").withColumn("kept", F.col("variance") > 0)


def impute_median(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Fill gaps with the exact medians of ``fitted_on`` (default: the rows themselves)."""
    base = df if fitted_on is None else fitted_on
    medians = {c: exact_quantiles(base, c, {"m": 0.5}).first()["m"] for c in columns}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m).cast("double")) for c, m in medians.items()})
