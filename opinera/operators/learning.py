"""Leakage-guarded features, a deterministic split, two classifiers, metrics, and exact attributions."""

from collections.abc import Sequence
from math import factorial

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, Imputer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinera.functions.dimensions import clean_tokens

# What a model may see, and what would give the label away.
NUMERIC = ("log1p_playtime_at_review", "steam_purchase_numeric", "received_for_free_numeric", "is_free_numeric", "log1p_price", "platform_windows_numeric", "platform_mac_numeric", "platform_linux_numeric")
TOKENS = ("genres_tokens", "categories_tokens")
SOURCES = ("playtime_at_review", "steam_purchase", "received_for_free", "is_free", "price", "platforms", "genres", "categories")
FORBIDDEN = ("voted_up", "recommendation_label", "votes_up", "votes_funny", "weighted_vote_score", "recommendationid", "game_name", "appid")


def require_no_leak(sources: Sequence[str] = SOURCES) -> None:
    leaking = sorted(set(sources) & set(FORBIDDEN))
    if leaking:
        raise ValueError(f"features would give the label away: {leaking}")


def _flag(value: Column) -> Column:
    return value.cast("int").cast("double")


def features(rows: DataFrame, label: bool = False) -> DataFrame:
    """A row a row. Negative amounts count as missing; each number has a flag for missing."""
    amount = lambda c: F.log1p(F.when(F.col(c) >= 0, F.col(c).cast("double")))
    numbers = [amount("playtime_at_review"), _flag(F.col("steam_purchase")), _flag(F.col("received_for_free")), _flag(F.col("is_free")), amount("price"), *(_flag(F.col(f"platforms.{p}")) for p in ("windows", "mac", "linux"))]
    kept = ["recommendationid", *([_flag(F.col("voted_up")).alias("label")] if label else [])]
    out = rows.select(*kept, *(x.alias(n) for x, n in zip(numbers, NUMERIC, strict=True)), clean_tokens(F.col("genres")).alias(TOKENS[0]), clean_tokens(F.col("categories")).alias(TOKENS[1]))
    return out.withColumns({f"{n}_missing": _flag(F.col(n).isNull()) for n in NUMERIC})


def sided(rows: DataFrame, key: str = "recommendationid", label: str = "label", fraction: float = 0.8, seed: int = 501) -> DataFrame:
    """rows with train, the same each time: floor(n * fraction) of each label are, in the order of a seeded hash.

    Only ids are ranked. The order is cut in 256 ranges of the hash; rows are ranked within one, after the sizes of
    those before, so a label with half of all rows isn't ranked in one task.
    """
    if not 0 < fraction < 1:
        raise ValueError("the training fraction must be between 0 and 1")
    hashed = rows.withColumn("_h", F.xxhash64(key, F.lit(str(seed)))).withColumn("_b", F.shiftright("_h", 56))
    counts = hashed.groupBy(label, "_b").agg(F.count("*").alias("_n"))
    sizes = counts.select(F.col(label).alias("_l"), F.col("_b").alias("_c"), F.coalesce(F.sum("_n").over(Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(label)).alias("_all"))
    ranked = hashed.withColumn("_r", F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", key)))
    placed = ranked.join(sizes, F.col(label).eqNullSafe(F.col("_l")) & (F.col("_b") == F.col("_c")))  # 256 rows a label
    return placed.select(*rows.columns, (F.col("_before") + F.col("_r") <= F.floor(F.col("_all") * fraction)).alias("train"))


def split(rows: DataFrame, key: str = "recommendationid", label: str = "label", fraction: float = 0.8, seed: int = 501) -> tuple[DataFrame, DataFrame]:
    """The two sides of sided()."""
    both = sided(rows, key, label, fraction, seed)
    return both.where("train").drop("train"), both.where(~F.col("train")).drop("train")


def class_weights(rows: DataFrame, label: str = "label") -> DataFrame:
    counts = rows.groupBy(label).agg(F.count("*").alias("rows"))
    return counts.withColumn("class_weight", F.sum("rows").over(Window.partitionBy(F.lit(1))) / (F.lit(2.0) * F.col("rows")))


def train(rows: DataFrame, classifier) -> PipelineModel:
    """Median imputation, binary token counts, one vector, then the classifier, weighted by class."""
    require_no_leak()
    weights = {r["label"]: r["class_weight"] for r in class_weights(rows).collect()}  # a row a label
    if set(weights) != {0.0, 1.0}:
        raise ValueError(f"training rows need both labels, not {sorted(weights)}")
    weighted = rows.withColumn("class_weight", F.when(F.col("label") == 1, weights[1.0]).otherwise(weights[0.0]))
    filled = [f"{n}_filled" for n in NUMERIC]
    stages = [Imputer(strategy="median", inputCols=list(NUMERIC), outputCols=filled)]
    stages += [CountVectorizer(inputCol=t, outputCol=f"{t}_vector", binary=True, minDF=1.0) for t in TOKENS]
    stages += [VectorAssembler(inputCols=[*filled, *(f"{n}_missing" for n in NUMERIC), *(f"{t}_vector" for t in TOKENS)], outputCol="features"), classifier]
    return Pipeline(stages=stages).fit(weighted)


def logistic() -> LogisticRegression:
    return LogisticRegression(maxIter=50, regParam=0.01, elasticNetParam=0.0, weightCol="class_weight")


def forest() -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=80, maxDepth=8, minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=501, weightCol="class_weight")


def feature_names(model: PipelineModel) -> list[str]:
    words = [f"{kind}={v}" for kind, stage in (("genre", 1), ("category", 2)) for v in model.stages[stage].vocabulary]
    return [*(f"{n}_filled" for n in NUMERIC), *(f"{n}_missing" for n in NUMERIC), *words]


def confusion(predictions: DataFrame) -> DataFrame:
    """Counts and scores of label and prediction; a score with nothing to divide by is 0."""
    hit = lambda y, p: F.count_if((F.col("label") == y) & (F.col("prediction") == p))
    cells = predictions.agg(hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(0, 0).alias("tn"), hit(1, 0).alias("fn"))
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    c = F.col
    scored = cells.withColumns({"accuracy": share(c("tp") + c("tn"), c("tp") + c("tn") + c("fp") + c("fn")), "precision": share(c("tp"), c("tp") + c("fp")), "recall": share(c("tp"), c("tp") + c("fn"))})
    return scored.withColumn("f1", share(2 * c("precision") * c("recall"), c("precision") + c("recall")))


def areas(predictions: DataFrame, score: str) -> dict[str, float]:
    found = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=score)
    return {m: found.evaluate(predictions, {found.metricName: m}) for m in ("areaUnderROC", "areaUnderPR")}


def majority(train_rows: DataFrame, test_rows: DataFrame) -> DataFrame:
    """test_rows with the commonest training label (the greater of a tie) as the prediction."""
    common = train_rows.groupBy("label").count().orderBy(F.desc("count"), F.desc("label")).first()["label"]
    return test_rows.withColumn("prediction", F.lit(float(common)))


def grouped_importance(importances: DataFrame) -> DataFrame:
    """(feature, importance) summed by attribute (what comes before '=') and brought to a sum of 1; zeros go."""
    grouped = importances.groupBy(F.split("feature", "=")[0].alias("attribute")).agg(F.sum("importance").alias("importance")).where("importance > 0")
    return grouped.withColumn("importance", F.col("importance") / F.sum("importance").over(Window.partitionBy(F.lit(1))))


def shapley(probabilities: Sequence[float], attributes: Sequence[str]) -> list[tuple[str, float]]:
    """Exact values from the model's output for each subset of attributes; bit i of a place says attribute i is in."""
    n = len(attributes)
    p = np.asarray(probabilities, float)
    if n > 16 or p.shape != (1 << n,) or not ((p >= 0) & (p <= 1)).all():
        raise ValueError(f"{n} attributes need {1 << n} probabilities")
    masks = np.arange(1 << n)
    sizes = np.bitwise_count(masks.astype(np.uint64)).astype(int)
    weight = np.array([factorial(k) * factorial(n - k - 1) / factorial(n) if k < n else 0.0 for k in range(n + 1)])
    out = []
    for i, name in enumerate(attributes):
        without = masks[masks >> i & 1 == 0]
        out.append((name, float((weight[sizes[without]] * (p[without | 1 << i] - p[without])).sum())))
    return sorted(out, key=lambda x: -abs(x[1]))


def coalitions(rows: DataFrame, background: dict[str, object], attributes: Sequence[str] = SOURCES) -> DataFrame:
    """Each row once for every subset of attributes: those in the subset as they are, the others from background."""
    sets = rows.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << len(attributes)) - 1))))
    types = dict(rows.dtypes)
    mixed = {a: F.when(F.shiftright("coalition", i) % 2 == 1, F.col(a)).otherwise(F.lit(background[a]).cast(types[a])) for i, a in enumerate(attributes)}
    return sets.withColumns(mixed)
