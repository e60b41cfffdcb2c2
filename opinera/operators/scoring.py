"""Models from training to answers: a run's files, predictions, and what a request is told about its review."""

import csv
import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinera.operators import learning, ranking
from opinera.operators.contracts import TRAINABLE
from opinera.sources.files import write_json

#: What a request may say of a review.
REQUEST = "recommendationid string, playtime_at_review int, steam_purchase boolean, received_for_free boolean, is_free boolean, price double, genres array<string>, categories array<string>, platforms struct<windows:boolean,mac:boolean,linux:boolean>"
#: A review of which nothing is known.
NOTHING = {"genres": [], "categories": [], "platforms": {"windows": None, "mac": None, "linux": None}}


def save(model: PipelineModel, root: str, run_id: str, name: str) -> str:
    path = f"{root.rstrip('/')}/{run_id}/{name}"
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predictions(model: PipelineModel, rows: DataFrame, name: str) -> DataFrame:
    """Each row's label, prediction and the probability of the positive class."""
    kept = ["recommendationid", *(["label"] if "label" in rows.columns else [])]
    return model.transform(rows).select(F.lit(name).alias("model"), *kept, "prediction", vector_to_array("probability")[1].alias("probability_positive"))


def sample(rows: DataFrame, most: int = 30) -> DataFrame:
    return ranking.top(rows, [F.asc("model"), F.asc("recommendationid")], most)


def overlap(train: DataFrame, test: DataFrame, key: str = "recommendationid") -> int:
    return train.select(key).join(test.select(key).distinct(), key, "left_semi").count()


def write_metrics(folder: str | Path, metrics: Sequence[dict], run_id: str) -> None:
    """The scores of each model as JSON and CSV, and the confusion counts as text."""
    folder, rows = Path(folder), [{"run_id": run_id, **m} for m in metrics]
    write_json(folder / "model_metrics.json", rows)
    with (folder / "model_metrics.csv").open("w", encoding="utf-8", newline="") as out:
        writer = csv.DictWriter(out, list(rows[0]), lineterminator="\n")
        writer.writeheader()
        writer.writerows(rows)
    cells = [f"{r['model']}: TP={r['tp']} FP={r['fp']} TN={r['tn']} FN={r['fn']}" for r in rows]
    (folder / "confusion_matrices.txt").write_text("\n".join([f"run_id={run_id}", *cells]) + "\n", encoding="utf-8")


def training_run(spark: SparkSession, base: DataFrame, root: str, run_id: str, folder: str | Path) -> dict[str, dict]:
    """Checks the base, trains both models and the majority rule, writes models, predictions and scores. Scores by model."""
    TRAINABLE.require(base)
    prepared = learning.features(base, label=True)
    train, test = learning.split(prepared)
    if shared := overlap(train, test):
        raise ValueError(f"{shared} reviews are on both sides of the split")
    found, parts = {}, []
    for name, classifier in (("logistic_regression", learning.logistic()), ("random_forest", learning.forest())):
        model = learning.train(train, classifier)
        save(model, f"{root}/models", run_id, name)
        parts.append(predictions(model, test, name))
    common = learning.majority(train, test).select(F.lit("majority").alias("model"), "recommendationid", "label", "prediction", F.col("prediction").alias("probability_positive"))
    every = parts[0].unionByName(parts[1]).unionByName(common)
    path = f"{root}/predictions/{run_id}"
    every.write.mode("overwrite").parquet(path)
    every = spark.read.parquet(path)
    for name in ("logistic_regression", "random_forest", "majority"):
        mine = every.where(F.col("model") == name)
        found[name] = {"model": name, **learning.confusion(mine).first().asDict(), **learning.areas(mine, "probability_positive")}
    write_metrics(folder, list(found.values()), run_id)
    write_json(Path(folder) / "run.json", {"run_id": run_id, "status": "PASS", "input_rows": prepared.count()})
    return found


def _as_row(request: dict, key: str) -> dict:
    return {"recommendationid": key, **{a: request.get(a, NOTHING.get(a)) for a in learning.SOURCES}}


def toggles(request: dict, options: dict[str, Sequence[str]]) -> list[tuple[dict, dict]]:
    """(row, what it stands for): the request with one genre or category more, or one less if it has it."""
    out = []
    for kind, column in (("genre", "genres"), ("category", "categories")):
        has = list(request.get(column) or [])
        for i, token in enumerate(dict.fromkeys(options.get(column, ()))):
            other = [t for t in has if t != token] if token in has else [*has, token]
            out.append((_as_row(request | {column: other}, f"whatif-{kind}-{i:03d}"), {"feature_type": kind, "value": token, "selected": token in has}))
    return out


def answer(spark: SparkSession, model: PipelineModel, request: dict, options: dict[str, Sequence[str]] | None = None) -> dict:
    """One transform for everything: the probability, exact shares of each attribute, and what toggling tokens would change."""
    n = len(learning.SOURCES)
    rows = [_as_row({a: v for i, a in enumerate(learning.SOURCES) if mask >> i & 1 and (v := request.get(a)) is not None}, f"mask-{mask:03d}") for mask in range(1 << n)]
    changed = toggles(request, options or {})
    frame = spark.createDataFrame(rows + [r for r, _ in changed], REQUEST)
    scored = {r["recommendationid"]: r for r in predictions(model, learning.features(frame), "answer").collect()}  # 2 ** 8 rows and the toggles
    chance = lambda key: float(scored[key]["probability_positive"])
    now = chance(f"mask-{(1 << n) - 1:03d}")
    effects = [{**what, "probability_after_toggle": chance(r["recommendationid"]), "probability_delta": chance(r["recommendationid"]) - now} for r, what in changed]
    return {
        "prediction": int(scored[f"mask-{(1 << n) - 1:03d}"]["prediction"]),
        "probability_positive": now,
        "baseline_probability": chance("mask-000"),
        "contributions": learning.shapley([chance(f"mask-{m:03d}") for m in range(1 << n)], learning.SOURCES),
        "what_if": sorted(effects, key=lambda e: (-e["probability_delta"], e["feature_type"], e["value"])),
    }


def health(spark: SparkSession, checks: dict[str, object]) -> dict:
    """Whether the session answers and each check (a function) does; a failed one is named, not raised."""
    found = {"spark": spark.range(1).count() == 1}
    for name, check in checks.items():
        try:
            found[name] = bool(check())
        except Exception as error:  # the answer is that it doesn't work
            found[name] = str(error) or type(error).__name__
    return {"status": "ok" if all(v is True for v in found.values()) else "degraded", "checks": found}


def as_json(value: dict) -> str:
    return json.dumps(value, sort_keys=True)
