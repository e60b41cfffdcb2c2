"""Files, steps, scheduling and the outbox."""

import datetime as dt
import os

import pytest

from opinera.operators import control
from opinera.sources import files
from opinera.streaming import outbox

NOW = dt.datetime(2024, 12, 30, tzinfo=dt.timezone.utc)


def test_actions():
    act = lambda **k: control.next_action(NOW, **{"last_week": None, "active": None, "open_": None, "queued": 0, "room": 5} | k)
    assert control.week(NOW) == "2025-W01" and act() == "REFRESH_DISCOVER" and act(last_week="2025-W01") == "SKIP_NOT_DUE" and act(last_week="2025-W01", force=True) == "REFRESH_DISCOVER"
    a = control.Batch("a", 5)
    assert act(open_=a) == "RESUME_ONBOARDING" and act(open_=a, room=4) == "WAIT_FOR_ONBOARDING_CAPACITY" and act(active=control.Batch("a", 5, True)) == "FINALIZE_COMPLETED_BATCH"
    with pytest.raises(RuntimeError):
        act(active=control.Batch("b", 1), open_=a)
    assert control.after_run({"last_successful_period": "x"}, NOW, "boom")["last_successful_period"] == "x" and control.after_run({}, NOW, None)["last_successful_period"] == "2025-W01"
    assert control.refresh_steps(5, 5, False) == ["snapshot"] and control.refresh_steps(6, 5, True) == ["snapshot", "analytics", "training"]


def test_steps_resume(tmp_path):
    ran = []

    def fail():
        raise OSError("no")

    steps = control.Steps(tmp_path / "s.json", "b")
    assert steps.run("one", lambda: ran.append(1))
    with pytest.raises(OSError):
        steps.run("two", fail)
    again = control.Steps(tmp_path / "s.json", "b")
    assert again.state["status"] == "FAILED" and not again.run("one", lambda: ran.append(1)) and again.run("two", lambda: ran.append(2)) and ran == [1, 2]
    with control.exclusive(tmp_path / "l"), pytest.raises(RuntimeError), control.exclusive(tmp_path / "l"):
        pass


def test_batches(spark):
    frame = lambda rows: spark.createDataFrame(rows, "batch_id string, status string, games int")
    assert control.unfinished(frame([("a", "COMPLETED", 1), ("b", "FAILED", 2)])) == control.Batch("b", 2) and control.unfinished(frame([("a", "ABANDONED", 1)])) is None
    with pytest.raises(RuntimeError):
        control.unfinished(frame([("a", "RUNNING", 1), ("b", None, 2)]))
    registry = spark.createDataFrame([(1, "QUEUED"), (2, "ACTIVE")], "appid int, state string")
    failed = {"status": "FAILED", "current_phase": "crawl", "steps": {"crawl": {}}}
    state, after = control.release_failed(failed, registry, registry.where("appid = 1"))
    assert state["status"] == "ABANDONED" and {r[0]: r[1] for r in after.collect()} == {1: "NEW", 2: "ACTIVE"}
    for bad, games in ((failed | {"steps": {"publish": {}}}, "appid = 1"), (failed | {"current_phase": "publish"}, "appid = 1"), (failed, "appid = 2")):
        with pytest.raises(RuntimeError):
            control.release_failed(bad, registry, registry.where(games))
    runs = spark.createDataFrame([("1", "PASS", "p"), ("3", "FAIL", "p"), ("2", "PASS", "p"), ("4", "PASS", "q")], "run_id string, status string, input_path string")
    assert control.last_training(runs, "p").first()["run_id"] == "2"
    assert [r[0] for r in control.to_probe(registry.select("appid"), spark.createDataFrame([(1, "s", "w"), (2, "s", "v")], "appid int, snapshot_id string, period string"), "s", "w").collect()] == [2]


def test_files(spark, tmp_path):
    (tmp_path / "7_x.jsonl").write_text('{"appid": 7, "n": 1}\n\n{"appid": 8, "n": 2}\n{bad\n')
    good, bad = files.read_jsonl_with_rejects(spark, str(tmp_path / "7_x.jsonl"), "appid int, n int")
    assert [r["n"] for r in good.collect()] == [1, 2] and [r["value"] for r in bad.collect()] == ["{bad"]
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "7_x.jsonl"), "appid int, n int").collect()
    row = files.file_profile(spark, str(tmp_path / "7_x.jsonl"), "appid", r"/(\d+)_").first()
    assert (row["lines"], row["unparsable"], row["keys"], row["misplaced"], len(row["md5"])) == (3, 1, 2, 2, 32)
    metrics = spark.createDataFrame([(20, 1, 0, 1, 0.0), (10, 3, 2, 1, 2 / 3)], files.METRICS_TSV)
    files.write_metrics_tsv(metrics, str(tmp_path / "m"))
    text = next((tmp_path / "m").glob("part-*.csv")).read_text()
    assert text == "10\t3\t2\t1\t0.666666666667\n20\t1\t0\t1\t0.000000000000\n" and files.read_metrics_tsv(spark, str(tmp_path / "m")).count() == 2
    a, b = tmp_path / "a", tmp_path / "b"
    a.write_text("1")
    assert files.publish(a, b) == "published" and files.publish(a, b) == "reused"
    a.write_text("2")
    with pytest.raises(FileExistsError):
        files.publish(a, b)
    staged = {tmp_path / "s1": b, tmp_path / "s2": tmp_path / "c"}
    for s in staged:
        s.write_text("new")

    def breaks(x, y):
        if x.name == "s2":
            raise OSError
        os.replace(x, y)

    with pytest.raises(OSError):
        files.promote(staged, breaks)
    assert b.read_text() == "1" and not (tmp_path / "c").exists()


def test_outbox(spark):
    polled = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (1, "b", 6), (2, "c", 7)], "appid int, recommendationid string, timestamp_created long")
    seen, started = spark.createDataFrame([(1, "a")], "appid int, recommendationid string"), spark.createDataFrame([(1,)], "appid int")
    mark, events = outbox.split_poll(polled, seen, started)
    assert mark.count() == 2 and [r["event_id"] for r in events.collect()] == ["REVIEW_CREATED:1:b"]
    assert outbox.gaps(polled, seen, started).count() == 0 and outbox.gaps(polled, seen.limit(0), started).first()["appid"] == 1
    assert outbox.unsent(events, events.limit(0)).count() == 1


def test_phases(tmp_path):
    ran = []
    actions = {p: (lambda p=p: ran.append(p)) for p in control.PHASES}
    steps = lambda: control.Steps(tmp_path / "state.json", "b1")
    assert control.run_phases(steps(), tmp_path / "lock", actions, "crawl") == "PAUSED" and ran == list(control.PHASES[:3])
    broken = actions | {"silver": lambda: 1 / 0}
    with pytest.raises(ZeroDivisionError):
        control.run_phases(steps(), tmp_path / "lock", broken)
    assert control.run_phases(steps(), tmp_path / "lock", actions) == "COMPLETED" and ran == list(control.PHASES)
    with pytest.raises(ValueError, match="activate"):
        control.run_phases(steps(), tmp_path / "lock", {})


def test_abandon_and_refresh(spark):
    import datetime as dt

    registry, games = spark.createDataFrame([(1, "NEW"), (2, "ACTIVE")], "appid int, state string"), spark.createDataFrame([(1,)], "appid int")
    failed = {"status": "FAILED", "current_phase": "crawl"}
    assert control.abandon_stale(failed, registry, games.limit(0), games, {})["status"] == "ABANDONED"
    for bad in ((failed | {"current_phase": "gold"}, registry, games.limit(0), games, {}), (failed, registry, games, games, {}), (failed, registry, games.limit(0), games, {"active_batch": "b"}), (failed, registry, games.limit(0), registry, {})):
        with pytest.raises(RuntimeError):
            control.abandon_stale(*bad)
    ran, now = [], dt.datetime(2024, 1, 1)
    actions = {a: (lambda a=a: ran.append(a)) for a in ("snapshot", "analytics", "training")}
    state = control.run_refresh({}, 10, now, (True, "NO_PRIOR_TRAINING"), actions)
    assert (ran, state["published_rows"], state["trained_rows"]) == (["snapshot", "analytics", "training"], 10, 10)
    assert control.run_refresh(state, 10, now, (False, "NO_NEW_ROWS"), actions)["training_reason"] == "NO_NEW_ROWS" and ran[3:] == ["snapshot"]
    with pytest.raises(ValueError):
        control.run_refresh(state, 9, now, (False, ""), actions)
