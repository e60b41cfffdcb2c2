"""Cleaning, quality, lifecycle, learning and attribution on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opinera.operators import cleaning, learning, lifecycle, quality, ranking, snapshots
from opinera.sources.schemas import GAMES


def _game(appid, free, listed=None, groups=None):
    data = {"name": "X", "is_free": free, "genres": [{"id": "1", "description": "Action"}], "package_groups": groups}
    data["price_overview"] = None if listed is None else {"currency": "EUR", "final": listed}
    return {"appid": appid, "data": data}


def _group(text="X - 1₫", recurring="false", subs=1, cents=1500):
    return {"name": "default", "title": "Buy X", "is_recurring_subscription": recurring, "subs": [{"option_text": text, "price_in_cents_with_discount": cents}] * subs}


def test_prices(spark):
    rows = [_game(1, True), _game(2, False, 999), _game(3, False, None, [_group()]), _game(4, False, None, [_group("X - $1")]), _game(5, False, None, [_group(), _group()]), _game(6, False, None, [_group(recurring="true")]), _game(7, False, None, [_group(subs=0)]), _game(8, False), _game(9, None, 999)]
    found = {r["appid"]: (r["price"], r["currency"]) for r in cleaning.games(spark.createDataFrame(rows, GAMES)).collect()}
    assert found == {1: (0.0, None), 2: (9.99, "EUR"), 3: (15.0, "VND"), 4: (15.0, None), 5: (None, None), 6: (None, None), 7: (None, None), 8: (None, None), 9: (None, None)}


def test_quality(spark):
    rows = spark.createDataFrame([("a", 0.5), ("a", 2.0), (" ", None)], "k string, rate double")
    with pytest.raises(quality.QualityError, match="blank k: 1.*rate outside 0..1: 2.*duplicate keys: 1"):
        quality.require(rows, [quality.blank("k"), quality.outside("rate", 0, 1)], ["k"])
    assert quality.require(rows.limit(1), [quality.blank("k")], ["k"], 1) == 1
    with pytest.raises(quality.QualityError, match="no rows"):
        quality.require(rows.limit(0), [])
    with pytest.raises(quality.QualityError, match="right lacks"):
        quality.require_same_keys(rows, rows.where("k = 'a'"), "k")
    quality.require_contract(rows, {"k": "string"})
    with pytest.raises(quality.QualityError):
        quality.require_contract(rows, {"k": "int", "z": "int"})
    assert quality.fingerprint(rows).first() == quality.fingerprint(rows.orderBy(F.desc("rate"))).first()


def test_lifecycle(spark):
    today, policy = "2024-06-30", lifecycle.Policy()
    rows = [(1, "game", "2024-05-31", "500", True, True), (2, "game", "1 Jun, 2024", "500", True, True), (3, "dlc", "soon", "x", False, None), (4, "game", "Jan 2, 2020", "499", True, True)]
    found = {r["appid"]: r for r in lifecycle.qualify(spark.createDataFrame(rows, "appid int, app_type string, release_date string, total_reviews string, metadata_available boolean, review_endpoint_available boolean"), policy, today).collect()}
    assert found[1]["qualified"] and found[1]["release_age_days"] == 30
    assert [r["rule"] for r in found[2]["reasons"]] == ["GAME_TOO_NEW"] and [r["rule"] for r in found[4]["reasons"]] == ["INSUFFICIENT_REVIEWS"]
    assert [r["rule"] for r in found[3]["reasons"]] == ["INVALID_APP_TYPE", "INVALID_RELEASE_DATE", "INSUFFICIENT_REVIEWS", "METADATA_UNAVAILABLE", "REVIEW_ENDPOINT_UNAVAILABLE"]
    registry = spark.createDataFrame([(1, "ACTIVE"), (2, "NEW"), (3, "REJECTED")], "appid int, state string")
    after = lifecycle.reconcile(registry, spark.createDataFrame([(1, False), (2, True), (3, False), (4, True), (5, False)], "appid int, qualified boolean"))
    assert {r["appid"]: r["state"] for r in after.collect()} == {1: "ACTIVE", 2: "QUALIFIED", 3: "REJECTED", 4: "QUALIFIED", 5: "REJECTED"}
    assert lifecycle.capacity(after, 3, 10).first()["capacity"] == 2
    assert {r["appid"]: r["action"] for r in lifecycle.onboarding_plan(after, 1).collect()} == {2: "QUEUED", 4: "DEFERRED"}


def test_retrain():
    now, day = dt.datetime(2024, 1, 10), dt.timedelta(days=1)
    assert lifecycle.retrain(5, now, None, None) == (True, "NO_PRIOR_TRAINING")
    assert lifecycle.retrain(5, now, 5, now - 30 * day) == (False, "NO_NEW_ROWS")
    assert lifecycle.retrain(1005, now, 5, now) == (True, "ENOUGH_NEW_ROWS")
    assert lifecycle.retrain(6, now, 5, now - 7 * day) == (True, "MODEL_AGE")
    assert lifecycle.retrain(6, now, 5, now - 6 * day) == (False, "TOO_FEW_NEW_ROWS")
    with pytest.raises(ValueError):
        lifecycle.retrain(4, now, 5, now)


def test_split_and_model(spark):
    rows = [(f"r{i}", 10, bool(i % 3), None if i == 4 else i, i + 5, i % 2 == 0, False, False, float(i), ["A", "B"] if i % 3 else ["C", " ", None], None, (True, i % 2 == 1, None if i == 7 else False)) for i in range(60)]
    schema = "recommendationid string, appid int, voted_up boolean, playtime_at_review int, playtime_forever int, steam_purchase boolean, received_for_free boolean, is_free boolean, price double, genres array<string>, categories array<string>, platforms struct<windows:boolean,mac:boolean,linux:boolean>"
    prepared = learning.features(spark.createDataFrame(rows, schema), label=True)
    train, test = learning.split(prepared)
    ids = lambda f: {r[0] for r in f.select("recommendationid").collect()}
    assert prepared.count() == 60 and not ids(train) & ids(test) and len(ids(train)) == 48 and ids(learning.split(prepared)[0]) == ids(train)
    model = learning.train(train, learning.logistic())
    scored = model.transform(test)
    assert learning.confusion(scored).first()["accuracy"] == 1.0 and learning.areas(scored, "rawPrediction")["areaUnderROC"] == 1.0
    assert {"genre=A", "genre=B", "genre=C", "log1p_price_missing"} <= set(learning.feature_names(model))
    with pytest.raises(ValueError):
        learning.require_no_leak(("price", "votes_up"))


def test_shapley_adds_up(spark):
    names = ["a", "b", "c"]
    p = [0.1 + 0.2 * (m & 1) + 0.3 * (m >> 1 & 1) + 0.1 * (m == 7) for m in range(8)]
    values = dict(learning.shapley(p, names))
    assert sum(values.values()) == pytest.approx(p[7] - p[0]) and values["a"] == pytest.approx(0.2 + 0.1 / 3)
    rows = learning.coalitions(spark.createDataFrame([(1, "x")], "a int, b string"), {"a": 0, "b": "y"}, ["a", "b"])
    assert {r["coalition"]: (r["a"], r["b"]) for r in rows.collect()} == {0: (0, "y"), 1: (1, "y"), 2: (0, "x"), 3: (1, "x")}


def test_snapshots_and_ranking(spark):
    a, b = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string"), spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    assert {r["k"]: r["v"] for r in snapshots.precedence_union(["k"], [a, b]).collect()} == {1: "old", 2: "old", 3: "new"}
    assert {r["k"]: r["action"] for r in snapshots.snapshot_changes(a, b, ["k"]).collect()} == {1: "deleted", 2: "matched", 3: "upserted"}
    assert [r["k"] for r in ranking.top_keeping(a.unionByName(b), [F.asc("k"), F.asc("v")], 2, F.col("v") == "new").collect()] == [1, 2]
    with pytest.raises(ValueError):
        ranking.page(a, [F.asc("k")], 0, 10)
    assert [r[0] for r in a.orderBy(ranking.domain_order(F.col("k"), [2, 1])).select("k").collect()] == [2, 1]


def test_plan_file(tmp_path):
    import json

    good = {
        "version": 1, "qualification": {"app_type": "game", "min_release_age_days": 30, "min_total_reviews": 2000, "require_metadata": True, "require_review_endpoint": True, "min_playtime_minutes": None},
        "onboarding": {"target_reviews_per_game": 2000, "max_new_games_per_cycle": 10}, "discovery": {"frequency": "weekly"},
        "catalog_refresh": {"enabled": True, "page_size": 50, "max_pages": 4, "request_delay_seconds": 0.8}, "retry": {"max_attempts": 3, "exponential_backoff": True},
    }
    path = tmp_path / "policy.json"
    path.write_text(json.dumps(good))
    plan = lifecycle.load_plan(path)
    assert (plan.frequency, plan.qualification.min_total_reviews, plan.request_delay_seconds) == ("WEEKLY", 2000, 0.8)
    for section, name, value in (("retry", "max_attempts", 0), ("qualification", "require_metadata", 1), ("onboarding", "target_reviews_per_game", True), ("discovery", "frequency", " ")):
        path.write_text(json.dumps(good | {section: good[section] | {name: value}}))
        with pytest.raises(ValueError, match=name):
            lifecycle.load_plan(path)
    path.write_text(json.dumps({"version": 1}))
    with pytest.raises(ValueError, match="lacks"):
        lifecycle.load_plan(path)
    with pytest.raises(ValueError):
        lifecycle.load_plan(tmp_path / "none.json")


def test_replaced_snapshot(spark, tmp_path):
    path, rows = f"{tmp_path}/snap", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert snapshots.replace_snapshot(spark, path, rows, ["k"]) == {"matched": 0, "upserted": 2, "deleted": 0}
    assert snapshots.replace_snapshot(spark, path, rows.withColumn("k", F.col("k") + 1), ["k"]) == {"matched": 1, "upserted": 1, "deleted": 1}
    with pytest.raises(ValueError, match="empty"):
        snapshots.replace_snapshot(spark, path, rows.limit(0), ["k"])
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [2, 3]
