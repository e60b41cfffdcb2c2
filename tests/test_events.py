"""Classification, quarantine, deduplication and sinks that may repeat a batch."""

import datetime as dt
import json

from pyspark.sql import functions as F

from opinera.operators import cleaning
from opinera.streaming import events

LOG = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
AT = dt.datetime(2024, 1, 1)


def _log(spark, messages, keys=None):
    rows = [((keys[i] if keys else "10").encode(), m.encode() if isinstance(m, str) else json.dumps(m).encode(), "t", 0, i, AT) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, LOG)


def _games(spark):
    return spark.createDataFrame([(10, "Ten", False, 1.0)], "appid int, game_name string, is_free boolean, price double")


def _review(**changes):
    return {"event_id": "e1", "event_type": "REVIEW_CREATED", "appid": 10, "event_time": "2024-01-01T00:00:00Z", "produced_at": "2024-01-01T00:00:01Z", "payload": {"recommendationid": "r1", "timestamp_created": 1704067200, "voted_up": True, "author": {"playtime_at_review": 90}}} | changes


def test_review_events(spark):
    found = events.review_events(_log(spark, [_review(), "{malformed", _review(event_time="soon", appid=11), _review(event_type=None)]), _games(spark)).orderBy("offset")
    reasons = [r["error_reason"] for r in found.collect()]
    assert reasons[0] == "" and reasons[3] == ""
    assert reasons[1].split(";") == ["MISSING_EVENT_ID", "INVALID_APPID", "INVALID_EVENT_TIME", "MISSING_PRODUCED_AT", "MISSING_PAYLOAD", "INVALID_RECOMMENDATIONID", "MISSING_TIMESTAMP_CREATED", "MISSING_VOTED_UP", "UNKNOWN_APPID"]
    assert reasons[2] == "INVALID_EVENT_TIME;UNKNOWN_APPID"
    assert events.quarantine(found).count() == 2 and events.archive(found).count() == 4
    clean = cleaning.reviews(events.review_rows(found.where("offset = 0"), _games(spark))).first()
    assert (clean["recommendationid"], clean["playtime_hours"], clean["recommendation_label"], clean["review_year"]) == ("r1", 1.5, 1, 2024)


def _players(**changes):
    return {"event_id": "p1", "event_type": "PLAYER_COUNT_SNAPSHOT", "schema_version": 1, "appid": 10, "event_time": "2024-01-01T00:10:00Z", "produced_at": "2024-01-01T00:10:01Z", "payload": {"player_count": 5}} | changes


def test_player_events(spark):
    messages = [_players(), _players(appid=99), _players(event_id=None, appid=99), _players(payload={"player_count": -1}), _players(schema_version=2), _players(produced_at="x"), _players()]
    found = events.player_events(_log(spark, messages, ["10"] * 6 + ["11"]), _games(spark)).orderBy("offset")
    assert [r["error_reason"] for r in found.collect()] == ["", "UNKNOWN_APPID", "MISSING_EVENT_ID", "INVALID_PLAYER_COUNT", "UNSUPPORTED_SCHEMA_VERSION", "INVALID_PRODUCED_AT", "KAFKA_KEY_APPID_MISMATCH"]
    gold = events.player_gold(events.player_silver(found), _games(spark)).first()
    assert gold["player_count"] == 5 and gold["observed_hour"] == dt.datetime(2024, 1, 1)
    assert events.latest_players(events.player_silver(found)).first()["observed_micros"] == 1704067800000000


def test_restart_does_not_replay(spark, tmp_path):
    spark.createDataFrame([("r1",)], "recommendationid string").write.json(str(tmp_path / "in"))
    for _ in range(2):
        live = spark.readStream.schema("recommendationid string").json(str(tmp_path / "in"))
        events.file_sink(live, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_sinks_take_a_batch_twice(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, AT), ("b", 2, AT)], "id string, n int, at timestamp")
    write = events.append_once(str(tmp_path / "gold"), "id")
    write(rows, 0), write(rows, 0)
    assert spark.read.parquet(str(tmp_path / "gold")).count() == 2
    upsert = events.upsert_once(str(tmp_path / "snap"), ["id"], ["at"])
    upsert(rows, 0), upsert(rows.withColumn("at", F.col("at") + F.expr("INTERVAL 1 DAY")).withColumn("n", F.lit(9)), 1)
    upsert(rows.withColumn("at", F.col("at") - F.expr("INTERVAL 1 DAY")), 2)
    assert [r["n"] for r in spark.read.parquet(str(tmp_path / "snap" / "0000000002")).collect()] == [9, 9]


def test_snapshots_survive_a_new_checkpoint(spark, tmp_path):
    row = lambda n, day: spark.createDataFrame([("a", n, AT + dt.timedelta(days=day))], "id string, n int, at timestamp")
    write = events.upsert_once(str(tmp_path / "snap"), ["id"], ["at"])
    for number, day in ((0, 0), (1, 1), (2, 2), (3, 3)):
        write(row(number, day), number)
    assert len(events._folders(spark, str(tmp_path / "snap"))) == 3
    write(row(-1, -5), 0)  # a stream that starts anew
    assert events.newest(spark, str(tmp_path / "snap")).first()["n"] == 3
    write(row(9, 9), 1)
    assert events.newest(spark, str(tmp_path / "snap")).first()["n"] == 9


def test_review_stream(spark, tmp_path):
    from opinera.sources.schemas import GAMES
    from opinera.streaming import wiring

    landed = spark.createDataFrame([{"appid": 10, "data": {"name": "Ten", "is_free": False, "genres": [{"id": "1", "description": "Action"}]}}], GAMES)
    games, known = cleaning.games(landed), spark.createDataFrame([("old",)], "recommendationid string")
    paths = wiring.Paths(f"file://{tmp_path}/data", f"file://{tmp_path}/state")
    say = lambda key, **more: _review(event_id=key, payload={"recommendationid": key, "timestamp_created": 1704067200, "voted_up": True, "author": {"playtime_at_review": 90}}, **more)
    log = f"{tmp_path}/log"
    _log(spark, [say("r1"), say("r1"), say("old"), say("r2", appid=-1)]).write.parquet(log)
    run = wiring.Reviews(paths, games, known)
    from opinera.sources.logs import read_landed_log

    count = lambda n: spark.read.parquet(paths.table(n)).count()
    run.run(spark, read_landed_log(spark, log))
    assert (count("archive"), count("quarantine"), count("reviews"), count("base")) == (4, 1, 1, 1)
    assert events.newest(spark, paths.table("recent")).select("_id", "game_type", "genres").first().asDict() == {"_id": "r1", "game_type": "PAID", "genres": ["Action"]}
    _log(spark, [say("r1"), say("r3")]).write.mode("append").parquet(log)
    run.run(spark, read_landed_log(spark, log))
    assert (count("archive"), count("reviews"), count("base")) == (6, 2, 2)
    window = events.newest(spark, paths.table("windows")).first()
    assert (window["review_count"], window["_id"]) == (2, "10:2024-01-01T00:00:00Z:2024-01-01T01:00:00Z")


def test_envelopes(spark):
    from opinera.streaming import contract

    times = spark.createDataFrame([("2024-01-01T02:00:00+02:00",), ("2024-01-01T00:00:00.5Z",), ("2024-01-01T00:00:00",), ("soon",), (None,), (" 2024-01-01T00:00:00Z ",)], "t string")
    assert [r[0] for r in times.select(contract.normalized(F.col("t"))).collect()] == ["2024-01-01T00:00:00+00:00", "2024-01-01T00:00:00.500000+00:00", None, None, None, "2024-01-01T00:00:00+00:00"]
    polled = spark.createDataFrame([(10, (" r1", 1704067200)), (0, ("", 0)), (None, None)], "appid int, review struct<recommendationid:string,timestamp_created:bigint>")
    good, bad, none = contract.review_envelopes(polled, "now").collect()
    assert (good["event_id"], good["event_time"], good["unfit"]) == ("REVIEW_CREATED:10:r1", "2024-01-01T00:00:00+00:00", "")
    assert bad["unfit"].count(";") == 2 and none["unfit"].count(";") == 2
    assert contract.fit(contract.review_envelopes(polled, "now")).count() == 1


def _player_query(spark, tmp_path, name, games, events):
    """Rows of the query and of its SQL over these games and (event, user)."""
    import duckdb

    from opinera.plans import platform  # noqa: F401
    from opinera.plans.queries import QUERIES, SQL

    con, d = duckdb.connect(), str(tmp_path / "in")
    spark.createDataFrame([(g, "a game", "Brand#2", "NEW", 1, 1.0) for g in games], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{d}/part.parquet")
    spark.createDataFrame([(e, AT, u, "view", 1.0, "{}") for e, u in events], "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{d}/events.parquet")
    for table in ("part", "events"):
        con.sql(f"CREATE VIEW {table} AS SELECT * REPLACE ({'ts::TIMESTAMP AS ts' if table == 'events' else 'p_size AS p_size'}) FROM '{d}/{table}.parquet/*.parquet'")
    found = QUERIES[name](spark, d)
    return sorted(map(tuple, found.collect())), sorted(con.sql(f"SELECT {', '.join(found.columns)} FROM ({SQL[name]})").fetchall())


def test_wrong_keys_are_wrong_for_every_game(spark, tmp_path):
    found, wanted = _player_query(spark, tmp_path, "player_counts", [77777, 77778], [(61, 77776), (64, 77776), (122, 77777)])
    assert found == wanted and [r[0] for r in found] == ["p64"]


def test_reasons_hold_whatever_ids_games_have(spark, tmp_path):
    found, wanted = _player_query(spark, tmp_path, "player_event_reasons", [77777, 99999999], [(61, 77776), (43, 77776), (64, 77776), (64, 99999998)])
    assert found == wanted and [r[:2] for r in found] == [("", 2), ("KAFKA_KEY_APPID_MISMATCH", 1), ("UNKNOWN_APPID", 1)]


def test_known_ids_at_the_edges(spark):
    games = spark.createDataFrame([(i,) for i in (8, 32768, 32769, 70000, 2147483647, 70000, None)], "appid int")
    asked = [8, 9, 16, 32767, 32768, 32769, 32770, 65536, 70000, 2147483647, 2147483646, -8, None]
    found = events.review_events(_log(spark, [_review(appid=i) for i in asked]), games).orderBy("offset").collect()
    assert [r["appid"] for r in found if "UNKNOWN_APPID" not in r["error_reason"]] == [8, 32768, 32769, 70000, 2147483647]
    assert len(found) == len(asked)


def test_streams_take_little_of_the_driver(spark, tmp_path, monkeypatch):
    from opinera.streaming import wiring

    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in a stream
    try:
        events.append_once(f"{tmp_path}/gold", "id")(spark.range(4000).select(F.col("id").cast("string")), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    gold = spark.read.parquet(f"{tmp_path}/gold")
    assert gold.count() == 4000 and len(gold.inputFiles()) <= events.KEY_BUCKETS
    _log(spark, [_review(), _review()]).write.parquet(f"{tmp_path}/log")
    live = events.review_events(spark.readStream.schema(LOG).parquet(f"{tmp_path}/log"), _games(spark))
    events.file_sink(events.once(events.valid(live), ["event_id"], "1 day").select("event_id"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
    assert not list(tmp_path.glob("state/**/*.delta")) and spark.conf.get("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", None) is None
    monkeypatch.setattr(wiring, "BROADCAST_GAMES", 1)
    few, many = spark.range(1), spark.range(2)
    plan = lambda games: many.join(wiring._sized(games), "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan(many) and "SortMergeJoin" not in plan(few)


def _shuffled(spark):
    """Shuffle files of this process."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (blocks.apply(i).getName() for i in range(blocks.size())) if n.startswith("shuffle_")}


def test_streams_take_little_disk(spark, tmp_path, monkeypatch):
    import time

    from opinera.operators import snapshots
    from opinera.sources.logs import read_landed_log
    from opinera.sources.staging import drop_folder
    from opinera.streaming import wiring

    log, running, kept = f"{tmp_path}/log", [], []
    _log(spark, [_review(), _review(appid=-1)]).write.parquet(log)
    paths = wiring.Paths(f"file://{tmp_path}/data", f"file://{tmp_path}/state")
    games = _games(spark).selectExpr("*", "'USD' AS currency", "array('a') AS genres", "array('b') AS categories", "CAST(NULL AS struct<windows:boolean,mac:boolean,linux:boolean>) AS platforms", "'soon' AS release_date")
    for name in ("file_sink", "batch_sink"):  # a query starts when no other runs
        start = getattr(events, name)
        monkeypatch.setattr(events, name, lambda *a, _start=start: (running.append(len(spark.streams.active)), _start(*a))[1])
    stream = wiring.Reviews(paths, games, spark.createDataFrame([], "recommendationid string"))
    assert stream._games.count() == 1  # a plain query's files stay
    before = _shuffled(spark)
    stream.run(spark, read_landed_log(spark, log), lambda: drop_folder(spark, log))
    for _ in range(100):
        if not _shuffled(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffled(spark) - before
    assert running == [0] * 6 and not (tmp_path / "log").exists()
    assert [spark.read.parquet(paths.table(n)).count() for n in ("archive", "quarantine", "reviews", "base")] == [2, 1, 1, 1]
    assert all(spark.read.parquet(paths.table(n)).inputFiles()[0].endswith(".zstd.parquet") for n in ("archive", "quarantine"))
    latest = snapshots.latest
    monkeypatch.setattr(snapshots, "latest", lambda *a: (kept.append(len(events._folders(spark, f"{tmp_path}/snap"))), latest(*a))[1])
    write = events.upsert_once(f"{tmp_path}/snap", ["id"], ["at"])
    for n in range(4):
        write(spark.createDataFrame([("a", n, AT + dt.timedelta(days=n))], "id string, n int, at timestamp"), n)
    assert kept == [0, 1, 2, 2] and events.newest(spark, f"{tmp_path}/snap").first()["n"] == 3


def test_a_wrong_document_is_not_written(spark, tmp_path):
    import pytest

    from opinera.operators import contracts

    rows = spark.createDataFrame([("a", []), ("b", ["appid must be positive"])], "_id string, wrong array<string>")
    write = events.upsert_once(f"{tmp_path}/snap", ["_id"], ["n"])
    put = lambda r, n: write(contracts.checked_documents(r).withColumn("n", F.lit(n)), n)
    put(rows.where("_id = 'a'"), 0)
    with pytest.raises(Exception, match="b: appid must be positive"):
        put(rows, 1)
    assert [r["_id"] for r in events.newest(spark, f"{tmp_path}/snap").collect()] == ["a"]
