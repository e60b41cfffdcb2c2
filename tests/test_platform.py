"""Contracts that break, served documents, dashboards, staged batches and scoring, on small frames."""

import datetime as dt
import json
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinera.operators import contracts, dashboard, learning, ranking, scoring, staged
from opinera.operators.quality import QualityError
from opinera.plans import reports
from tests.test_reports import ROWS, SCHEMA

AT = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_contracts_break(spark, base):
    games = spark.createDataFrame([(10,), (20,)], "appid int")
    reviews = base.select("recommendationid", "appid")
    good = contracts.BASE.require(reviews.where("appid < 30"), games, reviews.where("appid < 30"))
    assert (good["review_rows"], good["base_rows"], good["unmatched_reviews"]) == (4, 4, 0)
    with pytest.raises(QualityError, match="repeated games.*reviews of unknown games.*repeated base rows"):
        contracts.BASE.require(reviews, games.unionAll(games.limit(1)), reviews.unionAll(reviews.limit(1)))
    with pytest.raises(QualityError, match="rows were lost or added.*games without an id"):
        contracts.CLEAN_GAMES.require(games, spark.createDataFrame([(1,), (None,), (3,)], "appid int"))
    landed = base.select(F.struct("voted_up").alias("review"))
    cleaned = base.withColumn("recommendation_label", F.col("voted_up").cast("int"))
    assert contracts.CLEAN_REVIEWS.require(landed, cleaned)["landed_for"] == 3
    with pytest.raises(QualityError, match="labels differ from votes.*distribution"):
        contracts.CLEAN_REVIEWS.require(landed, cleaned.withColumn("recommendation_label", F.lit(1)))
    with pytest.raises(QualityError, match="rows don't add up"):
        contracts.CURRENT.require(reviews.limit(3), reviews, reviews.limit(4))
    assert contracts.CURRENT.require(reviews.where("appid < 30"), reviews, reviews)["overlap"] == 4
    with pytest.raises(QualityError, match="only one opinion"):
        contracts.TRAINABLE.require(base.where("voted_up"))
    with pytest.raises(QualityError, match="no rows"):
        contracts.READY.require(base.limit(0))


def test_published_reports_add_up(base):
    counts = contracts.READY.require(base)
    made = {n: f(base) for n, f in reports.PUBLISHED.items()}
    assert contracts.require_published(made, counts)["game_metrics"] == 3
    with pytest.raises(QualityError, match="playtime_metrics has 4 of 5"):
        contracts.require_published(made | {"playtime_metrics": reports.by_playtime(base.limit(4))}, counts)
    with pytest.raises(QualityError, match="missing"):
        contracts.require_published({"game_metrics": made["game_metrics"]}, counts)
    assert contracts.anomalies(base).count() == 0


def test_documents(spark):
    rows = spark.createDataFrame([(" r1 ", 1, AT, AT, "  ", [" b", "a", "a ", ""]), ("", 0, None, AT, "n", None)], "recommendationid string, appid int, timestamp_created timestamp, stream_ingested_at timestamp, game_name string, genres array<string>")
    good, bad = contracts.recent_review_documents(rows).collect()
    assert (good["_id"], good["game_name"], good["genres"], good["wrong"]) == ("r1", None, ["a", "b"], [])
    assert len(bad["wrong"]) == 3
    windows = spark.createDataFrame([(1, AT, AT + dt.timedelta(hours=1), 3, 2, 1), (1, AT, AT, 3, 2, 2)], "appid int, window_start timestamp, window_end timestamp, review_count int, positive_reviews int, negative_reviews int")
    found = contracts.window_documents(windows).collect()
    assert found[0]["_id"] == "1:2024-01-01T00:00:00Z:2024-01-01T01:00:00Z" and found[0]["wrong"] == [] and len(found[1]["wrong"]) == 2
    assert contracts.require_documents(contracts.window_documents(windows.limit(1))).count() == 1
    with pytest.raises(QualityError, match="must end after"):
        contracts.require_documents(contracts.window_documents(windows))
    players = spark.createDataFrame([(1, 5, "e", "n", AT), (1, -1, " ", None, None)], "appid int, player_count long, event_id string, game_name string, observed_at timestamp")
    assert [len(r["wrong"]) for r in contracts.player_documents(players).collect()] == [0, 4]
    assert contracts.plain({"a": Decimal("1.5"), "b": [np.int64(2), (np.float32(0.5),)], "c": "x"}) == {"a": 1.5, "b": [2, [0.5]], "c": "x"}
    assert contracts.plain(windows.select("appid").first()) == {"appid": 1}


def test_dashboard(spark):
    games = spark.createDataFrame([(1, "B", 4, 2, 2, 0.5, 3), (2, "A", 4, 2, 2, 0.5, None), (3, "C", 2, 2, 0, 1.0, 2)], "appid int, game_name string, review_count long, positive_reviews long, negative_reviews long, recommendation_rate double, batch_review_count long")
    assert dashboard.totals(games).first().asDict() == {"total_reviews": 10, "batch_reviews": 9, "positive_reviews": 6, "negative_reviews": 4, "recommendation_rate": 0.6}
    assert dashboard.totals(games.limit(0)).first()["recommendation_rate"] == 0
    assert [r["appid"] for r in dashboard.top_by_name(games).collect()] == [3, 2, 1]
    assert [r["appid"] for r in dashboard.samples(games, games.withColumnRenamed("game_name", "genre"))[0].collect()] == [3, 1, 2]
    assert [r["appid"] for r in dashboard.search(games, "b 1").collect()] == [1]
    reviews = spark.createDataFrame([(1, " own "), (1, " "), (9, None)], "appid int, game_name string")
    assert sorted(r["game_name"] for r in dashboard.named_reviews(reviews, games).collect()) == ["B", "Unknown game", "own"]
    buckets = spark.createDataFrame([("50h+", 1), (None, 2), ("0-2h", 3), ("odd", 0)], "playtime_bucket string, review_count long")
    assert [r["playtime_bucket"] for r in dashboard.playtime_in_order(buckets).collect()][:2] == ["0-2h", "50h+"]
    assert [r["bucket_label"] for r in dashboard.rarest_playtime_first(buckets).collect()] == ["odd", "50h+", "MISSING", "0-2h"]
    values = spark.createDataFrame([("a", -3.0), ("b", 2.0), ("c", 3.0)], "feature string, value double")
    assert [r["feature"] for r in dashboard.strongest(values, 2).collect()] == ["a", "c"]
    assert dashboard.preview(values, [F.desc("value")], 1) == [{"feature": "c", "value": 3.0}]


def test_numbered(spark):
    rows = spark.createDataFrame([("a" if i % 3 else "b", (i * 37) % 1000) for i in range(1000)], "g string, k int")
    found = {(r["g"], r["k"]): (r["rn"], r["n"]) for r in ranking.numbered(rows, "k", "g").collect()}
    for g in "ab":
        keys = sorted(k for h, k in found if h == g)
        assert [found[g, k] for k in keys] == [(i + 1, len(keys)) for i in range(len(keys))]
    assert ranking.numbered(rows.limit(0), "k", "g").count() == 0


def test_manifest(spark):
    good = staged.Manifest("batch-1", ((1, "A"), (2, "B")), 3)
    assert good.frame(spark).count() == 2
    with pytest.raises(QualityError, match="batch id.*policy version.*repeated games.*without an id"):
        staged.Manifest("-", ((1, "A"), (1, " ")), 3, 0)
    with pytest.raises(QualityError, match="no games"):
        staged.Manifest("b", (), 3)
    queue, registry = spark.createDataFrame([(2, "B"), (1, "A"), (3, "C")], "appid int, name string"), spark.createDataFrame([(1, "QUEUED"), (2, "QUEUED"), (3, "ACTIVE")], "appid int, state string")
    assert staged.manifest_from_queue("b", queue, registry, 3, 2).games == ((1, "A"), (2, "B"))
    with pytest.raises(QualityError):
        staged.manifest_from_queue("b", queue, registry, 3, 1)
    probed = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (9, "z")], "appid int, data string")
    assert staged.stage_metadata(good.frame(spark), probed).count() == 2
    with pytest.raises(QualityError, match="no metadata"):
        staged.stage_metadata(queue, probed)
    assert staged.collisions(queue, probed).count() == 2


def test_staged_batch(spark):
    games, meta = spark.createDataFrame([(1,), (2,)], "appid int"), spark.createDataFrame([(1, True, "A"), (2, True, "B")], "appid int, success boolean, name string")
    rows = [(1, 1, "a", "english", True), (1, 1, "b", "english", False), (2, 2, "c", "english", True), (2, 2, "d", "english", True)]
    schema = "file_appid int, appid int, recommendationid string, language string, voted_up boolean"
    none = spark.createDataFrame([], "recommendationid string")
    staged.require_staged(staged.findings(games, meta, spark.createDataFrame(rows, schema), none, 2))
    bad = spark.createDataFrame([*rows[:3], (2, 1, "a ", "german", None), (3, 3, " ", "english", True)], schema)
    found = {r["rule"] for r in staged.findings(games, meta.limit(1), bad, spark.createDataFrame([("a",)], "recommendationid string"), 2).collect()}
    assert found == {"missing metadata", "unexpected review file", "review in another game's file", "review without an id", "review of several games", "review that isn't English", "review without an opinion", "review that is published"}
    with pytest.raises(QualityError, match="wrong number of reviews: 2"):
        staged.require_staged(staged.findings(games, meta, bad.limit(0), none, 2))
    gaps = staged.evidence_gaps(games, {"page": meta.limit(1), "probe": spark.createDataFrame([(1,), (2,), (5,)], "appid int")})
    assert sorted(map(tuple, gaps.collect())) == [("no page", 2), ("probe of another", 5)]


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    rows = []
    for i in range(240):
        up = i % 3 > 0
        rows.append((f"r{i:03d}", i % 7, up, (i * 13) % 900 + (600 if up else 0), i % 2 == 0, i % 5 == 0, i % 4 == 0, float(i % 50), ["Action"] if up else ["Puzzle", "Action"], ["Solo"], (True, i % 2 == 0, False)))
    schema = "recommendationid string, appid int, voted_up boolean, playtime_at_review int, steam_purchase boolean, received_for_free boolean, is_free boolean, price double, genres array<string>, categories array<string>, platforms struct<windows:boolean,mac:boolean,linux:boolean>"
    folder = tmp_path_factory.mktemp("run")
    return folder, scoring.training_run(spark, spark.createDataFrame(rows, schema), f"file://{folder}", "run1", folder / "evidence")


def test_training_run(spark, trained):
    folder, found = trained
    assert set(found) == {"logistic_regression", "random_forest", "majority"} and found["random_forest"]["areaUnderROC"] > 0.8
    written = json.loads((folder / "evidence/model_metrics.json").read_text())
    assert [r["run_id"] for r in written] == ["run1"] * 3 and (folder / "evidence/model_metrics.csv").read_text().count("\n") == 4
    assert "majority: TP=" in (folder / "evidence/confusion_matrices.txt").read_text()
    every = spark.read.parquet(f"{folder}/predictions/run1")
    assert every.select("model").distinct().count() == 3 and scoring.sample(every, 5).count() == 5
    assert json.loads((folder / "evidence/run.json").read_text())["status"] == "PASS"


def test_answer(spark, trained):
    folder, _ = trained
    model = scoring.load(f"{folder}/models/run1/random_forest")
    request = {"playtime_at_review": 700, "steam_purchase": True, "is_free": False, "price": 10.0, "genres": ["Action"], "categories": ["Solo"], "platforms": {"windows": True, "mac": None, "linux": None}}
    found = scoring.answer(spark, model, request, {"genres": ["Puzzle", "Action", "Puzzle"], "categories": ["Multi"]})
    assert found["probability_positive"] == pytest.approx(found["baseline_probability"] + sum(v for _, v in found["contributions"]))
    assert [e["value"] for e in found["what_if"] if e["selected"]] == ["Action"] and len(found["what_if"]) == 3
    deltas = [e["probability_delta"] for e in found["what_if"]]
    assert deltas == sorted(deltas, reverse=True) and {n for n, _ in found["contributions"]} == set(learning.SOURCES)
    assert scoring.health(spark, {"model": lambda: model is not None})["status"] == "ok"
    assert scoring.health(spark, {"store": lambda: 1 / 0}) == {"status": "degraded", "checks": {"spark": True, "store": "division by zero"}}
