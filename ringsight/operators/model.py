"""The transaction classifier: inputs, split, training, blending with the rules, and what drove a score."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringsight.config import DEFAULT, Settings
from ringsight.operators.features import FEATURES
from ringsight.session import materialize

# The model's inputs, in order.
RULE_FLAGS = ("card_testing_flag", "high_deviation_flag", "odd_hour_new_category_flag")
INPUTS = (*FEATURES, *RULE_FLAGS)
# Lower bounds of a "high" and a "medium" contribution.
HIGH, MEDIUM = 0.5, 0.1


def prepare_data(features: DataFrame) -> DataFrame:
    """The eleven inputs as doubles beside the row; the label too, when there is one.

    A row without a z-score (unknown account) keeps a null there.
    """
    known = "triggered_rules" in features.columns
    flags = {f: (F.array_contains("triggered_rules", f).cast("double") if known else F.lit(0.0)) for f in RULE_FLAGS}
    ready = features.withColumns({**{c: F.col(c).cast("double") for c in FEATURES}, **flags})
    if "label_fraud" in features.columns:
        ready = ready.withColumn("label", F.col("label_fraud").cast("double"))
    return ready


def holdout_cuts(rows: DataFrame, cfg: Settings = DEFAULT) -> dict[bool | None, str | None]:
    """Per label the hash up to which rows are held out: exactly `holdout_percent` of the label's rows, rounded to whole rows.

    The k-th smallest md5 of the ids is found by counting hex digits, three at a time: every pass counts the rows whose hash goes on
    from the prefix found so far, per label and next digits, and keeps the digits in which the k-th lies. Nothing is sorted; a pass
    sends at most 4096 counts per label through one small shuffle and to the driver. Rows of one id stay together.
    """
    label = F.col("label_fraud") if "label_fraud" in rows.columns else F.lit(None).cast("boolean")
    ids = rows.select(label.alias("label"), F.md5("txn_id").alias("hash"))
    totals = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.count("hash").alias("n")).collect()}
    wanted = {x: (n * cfg.holdout_percent + 50) // 100 for x, n in totals.items()}
    cuts: dict[bool | None, str | None] = {x: None for x, k in wanted.items() if k == 0}
    prefix = {x: "" for x, k in wanted.items() if k}
    while prefix:
        size = len(next(iter(prefix.values())))
        inside = F.lit(False)
        for x, start in prefix.items():
            inside = inside | (F.col("label").eqNullSafe(F.lit(x)) & F.col("hash").startswith(start))
        counts = ids.where(inside).groupBy("label", F.substring("hash", size + 1, 3).alias("digits")).agg(F.count(F.lit(1)).alias("n"))
        found = counts.orderBy("digits").collect()
        for x in list(prefix):
            left = wanted[x]
            for r in found:
                if r["label"] == x:
                    if left <= r["n"]:
                        break
                    left -= r["n"]
            prefix[x] += r["digits"]
            if left == r["n"] or len(prefix[x]) == 32:
                cuts[x] = prefix.pop(x)
            else:
                wanted[x] = left
    return cuts


def is_holdout(cuts: dict[bool | None, str | None], labelled: bool = True) -> Column:
    """Whether a row is held out: the same rows on every run and in every engine, without a shuffle."""
    label = F.col("label_fraud") if labelled else F.lit(None).cast("boolean")
    chosen = F.lit(False)
    for x, cut in cuts.items():
        if cut is not None:
            chosen = chosen | (label.eqNullSafe(F.lit(x)) & (F.substring(F.md5("txn_id"), 1, len(cut)) <= cut))
    return F.coalesce(chosen, F.lit(False))


def split(features: DataFrame, cfg: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(training rows, held-out rows), stratified by label. `features` is read a few times (ids and labels): pass a written table."""
    held = is_holdout(holdout_cuts(features, cfg), "label_fraud" in features.columns)
    return features.where(~held), features.where(held)


def bin_bounds(inputs: DataFrame, bins: int) -> list[list[float]]:
    """Per input the bounds between bins, ascending, from all rows: half way between the last value of a bin and the next one.

    Equal shares of the rows end a bin. A value that takes several shares is one bin, and the shares left are dealt again over the rows
    of all other values, until there are `bins` or every value has its own. So rare values beside a common one are told apart.
    A pass is one aggregate over the rows (quantile summaries, within 1 in 10,000 of the rank); only the bounds reach the driver. An
    input of a single value has one bound, which parts nothing.
    """
    chosen: list[list[float]] = [[] for _ in INPUTS]
    going = list(range(len(INPUTS)))
    while going:
        wanted = []
        for k in going:
            rest = F.col(INPUTS[k])
            left = bins - len(chosen[k])
            others = F.when(~rest.isin(chosen[k]), rest) if chosen[k] else rest
            wanted.append(F.percentile_approx(others, [i / left for i in range(1, left + 1)], 10_000).alias(str(k)))
        found = inputs.agg(*wanted).first()
        for k in list(going):
            chosen[k] += sorted(set(found[str(k)] or []))
            if not found[str(k)] or len(chosen[k]) >= bins:
                going.remove(k)
    ends = [sorted(x)[:-1] for x in chosen]
    places = [(k, v) for k, x in enumerate(ends) for v in x]
    following = [F.min(F.when(F.col(INPUTS[k]) > v, F.col(INPUTS[k]))).alias(str(i)) for i, (k, v) in enumerate(places)]
    found = inputs.agg(*following).first() if places else []
    bounds: list[list[float]] = [[] for _ in INPUTS]
    for (k, v), after in zip(places, found, strict=True):
        half = v + (after - v) / 2
        # two neighbours in floating point, or infinite values
        bounds[k].append(half if v < half < float("inf") else float(np.nextafter(v, np.inf)))
    return [x or [0.0] for x in bounds]


def train(features: DataFrame, cfg: Settings = DEFAULT) -> PipelineModel:
    """Fit on all rows outside the hold-out share.

    The booster looks at bins of the inputs only, so rows of the same bins and label are one row with a weight: the same sums and the
    same trees as from every row alone. `maxBins` is set so high that Spark takes every bin bound as a candidate, not those of a sample.
    """
    if "label_fraud" not in features.columns:
        raise ValueError("training rows need label_fraud")
    rows, _ = split(features, cfg)
    inputs = prepare_data(rows).select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in INPUTS], "label")
    binned = [f"{c}_bin" for c in INPUTS]
    splits = [[float("-inf"), *bounds, float("inf")] for bounds in bin_bounds(inputs, cfg.bins)]
    bucketizer = Bucketizer(inputCols=list(INPUTS), outputCols=binned, splitsArray=splits)
    # plain numbers: the bucketizer's own columns would be taken for categories
    keys = [F.col(b).cast("int").alias(b) for b in binned]
    cells = bucketizer.transform(inputs).groupBy(*keys, "label").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    cells = materialize(cells, "training-cells")
    n = cells.count()
    cells = cells.repartition(max(1, min(cells.sparkSession.sparkContext.defaultParallelism, n // cfg.training_cells_per_task)))
    booster = GBTClassifier(
        featuresCol="inputs",
        labelCol="label",
        weightCol="weight",
        maxIter=cfg.trees,
        stepSize=cfg.learning_rate,
        maxDepth=cfg.depth,
        maxBins=max(cfg.bins, math.isqrt(n) + 1),
        seed=cfg.seed,
        cacheNodeIds=False,
        maxMemoryInMB=1024,
    )
    assembler = VectorAssembler(inputCols=binned, outputCol="inputs")
    return PipelineModel([bucketizer, assembler, booster.fit(assembler.transform(cells))])


def with_probability(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds `probability` of fraud."""
    filled = [F.coalesce(c, F.lit(0.0)).alias(c) for c in INPUTS]
    extra = [c for c in features.columns if c not in INPUTS]
    inputs = prepare_data(features).select(*extra, F.struct(*INPUTS).alias("given"), *filled)
    scored = model.transform(inputs).withColumn("p", vector_to_array("probability")[1])
    return scored.select(*extra, *[F.col(f"given.{c}").alias(c) for c in INPUTS], F.col("p").alias("probability"))


def blended_score(cfg: Settings = DEFAULT) -> Column:
    """Rules at full score force a floor; otherwise a weighted mean of rules and model."""
    rules, model = F.col("rule_score"), F.col("probability")
    mixed = rules * cfg.rule_share + model * (1 - cfg.rule_share)
    return F.round(F.when(rules >= 1.0, F.greatest(F.lit(cfg.override_floor), model)).otherwise(mixed), 4)


def input_statistics(prepared: DataFrame) -> DataFrame:
    """One row: a struct of mean and sample deviation of every input over the batch."""
    fields = []
    for c in INPUTS:
        fields += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    return prepared.agg(F.struct(*fields).alias("statistics"))


def top_features(statistics: Column, importances: list[float]) -> Column:
    """The two inputs furthest from the batch mean, weighted by importance; on ties the later input comes first."""
    items = []
    for place, (name, importance) in enumerate(zip(INPUTS, importances)):
        std = F.coalesce(F.nullif(statistics[f"{name}_std"], F.lit(0.0)), F.lit(1.0))
        pull = F.abs((F.col(name) - statistics[f"{name}_mean"]) / std) * float(importance)
        items.append(
            F.struct(
                F.coalesce(pull, F.lit(float("inf"))).alias("rank"),
                F.lit(place).alias("place"),
                F.lit(name).alias("feature"),
                F.col(name).alias("value"),
                F.when(pull > HIGH, "high").when(pull > MEDIUM, "medium").otherwise("low").alias("contribution"),
            )
        )
    # no lambda functions here: Spark would interpret the whole expression for every row
    ordered = F.sort_array(F.array(*items), asc=False)
    return F.array(*[F.struct(*[ordered[i][name].alias(name) for name in ("feature", "value", "contribution")]) for i in (0, 1)])


def predict(features: DataFrame, model: PipelineModel, cfg: Settings = DEFAULT) -> DataFrame:
    """(txn_id, account_id, layer1_score, triggered_rules, top_features) for a batch.

    `features` is read twice (statistics, rows): pass a written table.
    """
    prepared = prepare_data(features)
    statistics = input_statistics(prepared).scalar()
    importances = [float(x) for x in model.stages[-1].featureImportances.toArray()]
    return layer1_output(with_probability(features, model), statistics, importances, cfg)


def layer1_output(scored: DataFrame, statistics: Column, importances: list[float], cfg: Settings = DEFAULT) -> DataFrame:
    """The published layer-1 rows for inputs that already carry `probability`."""
    return scored.withColumn("statistics", statistics).select(
        "txn_id",
        "account_id",
        blended_score(cfg).alias("layer1_score"),
        "triggered_rules",
        top_features(F.col("statistics"), importances).alias("top_features"),
    )
