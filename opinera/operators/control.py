"""What a scheduler does next, steps that resume, one run at a time, and batches that failed."""

import fcntl
import json
import shutil
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinera.sources.files import write_json

ENDED = ("COMPLETED", "ABANDONED")


def week(now: datetime) -> str:
    iso = now.astimezone(timezone.utc).isocalendar()
    return f"{iso.year}-W{iso.week:02d}"


@dataclass(frozen=True)
class Batch:
    batch_id: str
    games: int
    ended: bool = False


def unfinished(batches: DataFrame) -> Batch | None:
    """The batch (batch_id, status, games) that hasn't ended; more than one needs a person."""
    open_ = batches.where(~F.col("status").isin(*ENDED) | F.col("status").isNull()).orderBy("batch_id").limit(2).collect()
    if len(open_) > 1:
        raise RuntimeError(f"several unfinished batches: {[r['batch_id'] for r in open_]}")
    return Batch(open_[0]["batch_id"], open_[0]["games"]) if open_ else None


def next_action(now: datetime, last_week: str | None, active: Batch | None, open_: Batch | None, queued: int, room: int, force: bool = False) -> str:
    """active: the batch that the scheduler started, as far as it knows; open_: the unfinished one on disk."""
    if active and open_ and active.batch_id != open_.batch_id:
        raise RuntimeError(f"the scheduler's batch {active.batch_id} isn't the unfinished {open_.batch_id}")
    if active and not open_ and active.ended:
        return "FINALIZE_COMPLETED_BATCH"
    if batch := open_ or active:
        return "RESUME_ONBOARDING" if (batch.games or queued) <= room else "WAIT_FOR_ONBOARDING_CAPACITY"
    return "REFRESH_DISCOVER" if force or last_week != week(now) else "SKIP_NOT_DUE"


def after_run(state: dict, now: datetime, error: str | None) -> dict:
    """The state after an attempt: a failure is kept, but the week isn't used up."""
    out = state | {"last_attempt_at": now.isoformat(), "last_attempt_period": week(now), "last_attempt_status": "FAILED" if error else "SUCCESS", "last_error": error}
    return out if error else out | {"last_successful_run": now.isoformat(), "last_successful_period": week(now)}


@contextmanager
def exclusive(path: str | Path) -> Iterator[None]:
    """One run at a time; a second one fails at once."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with Path(path).open("a") as lock:
        try:
            fcntl.flock(lock, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError as held:
            raise RuntimeError(f"another run holds {path}") from held
        yield


class Steps:
    """Named steps whose outcome is on disk: completed ones are skipped when the run is started again."""

    def __init__(self, path: str | Path, batch_id: str):
        self.path = Path(path)
        self.state = json.loads(self.path.read_text()) if self.path.exists() else {"batch_id": batch_id, "status": "RUNNING", "steps": {}}
        if self.state["batch_id"] != batch_id:
            raise ValueError(f"{path} belongs to batch {self.state['batch_id']}")

    def _put(self, name: str, status: str, batch: str, error: str | None = None) -> None:
        self.state["steps"][name] = {"status": status, "error": error}
        self.state |= {"status": batch, "current_phase": name}
        write_json(self.path, self.state)

    def run(self, name: str, action: Callable[[], None]) -> bool:
        if self.state["steps"].get(name, {}).get("status") == "COMPLETED":
            return False
        self._put(name, "RUNNING", "RUNNING")
        try:
            action()
        except BaseException as error:
            self._put(name, "FAILED", "FAILED", str(error))
            raise
        self._put(name, "COMPLETED", "RUNNING")
        return True

    def finish(self, status: str = "COMPLETED") -> None:
        self.state["status"] = status
        write_json(self.path, self.state)


#: What an onboarding run does, in order.
PHASES = ("runtime", "prepare", "crawl", "validate", "publish_bronze", "verify_bronze", "silver", "gold", "analytics", "serving", "readiness", "activate")


def run_phases(steps: Steps, lock: str | Path, actions: dict[str, Callable[[], None]], stop_after: str | None = None) -> str:
    """Runs every phase that isn't done, one run at a time. The status it ends with: COMPLETED, or PAUSED after stop_after."""
    if missing := [p for p in PHASES if p not in actions]:
        raise ValueError(f"no action for {missing}")
    with exclusive(lock):
        for phase in PHASES:
            steps.run(phase, actions[phase])
            if phase == stop_after:
                steps.finish("PAUSED")
                return "PAUSED"
        steps.finish()
    return "COMPLETED"


#: Steps before which a failed batch has touched nothing downstream.
BEFORE_CRAWL = ("manifest", "preflight", "metadata", "crawl")


def release_failed(state: dict, registry: DataFrame, games: DataFrame) -> tuple[dict, DataFrame]:
    """A batch that failed while crawling is abandoned and its queued games are new again; anything further is refused."""
    if state.get("status") != "FAILED" or state.get("current_phase") != "crawl":
        raise RuntimeError("only a batch that failed while crawling can be released")
    further = sorted(set(state.get("steps", {})) - set(BEFORE_CRAWL))
    if further:
        raise RuntimeError(f"steps after crawling exist: {further}")
    mine = games.select("appid").distinct().withColumn("_mine", F.lit(True))
    joined = registry.join(mine, "appid", "left")
    strange = joined.where(F.col("_mine") & (F.col("state") != "QUEUED")).limit(1).collect()
    if strange:
        raise RuntimeError(f"game {strange[0]['appid']} is {strange[0]['state']}, not queued")
    return state | {"status": "ABANDONED"}, joined.withColumn("state", F.when(F.col("_mine"), F.lit("NEW")).otherwise(F.col("state"))).drop("_mine")


def require_space(path: str | Path, gigabytes: float) -> None:
    free = shutil.disk_usage(path).free / 1e9
    if free < gigabytes:
        raise OSError(f"{free:.1f} GB free at {path}, {gigabytes} needed")


def last_training(runs: DataFrame, input_path: str) -> DataFrame:
    """The newest run (run_id, status, input_path, ...) that passed on that input: a row or none."""
    return runs.where((F.col("status") == "PASS") & (F.col("input_path") == input_path)).orderBy(F.desc("run_id")).limit(1)


def refresh_steps(rows: int, published_rows: int | None, train: bool) -> list[str]:
    """What follows a new snapshot of `rows` rows; it never shrinks."""
    if published_rows is not None and rows < published_rows:
        raise ValueError(f"the snapshot shrank from {published_rows} to {rows} rows")
    return ["snapshot", *(["analytics"] if rows != published_rows else []), *(["training"] if train else [])]


def to_probe(candidates: DataFrame, cache: DataFrame, snapshot: str, period: str) -> DataFrame:
    """Candidates whose feasibility isn't known for this snapshot and week."""
    known = cache.where((F.col("snapshot_id") == snapshot) & (F.col("period") == period)).select("appid")
    return candidates.join(known, "appid", "left_anti")


def abandon_stale(state: dict, registry: DataFrame, queue: DataFrame, games: DataFrame, scheduler: dict) -> dict:
    """The state of a batch that failed while crawling and was cleared away by hand: its games are new and unqueued, and
    the scheduler has nothing under way. Nothing but the state changes."""
    if state.get("status") != "FAILED" or state.get("current_phase") != "crawl":
        raise RuntimeError("only a batch that failed while crawling can be abandoned")
    if scheduler.get("active_batch"):
        raise RuntimeError(f"the scheduler has {scheduler['active_batch']} under way")
    strange = registry.join(games.select("appid"), "appid", "left_semi").where("state <> 'NEW' OR state IS NULL").limit(1).collect()
    if strange:
        raise RuntimeError(f"game {strange[0]['appid']} is {strange[0]['state']}, not new")
    if not queue.join(games.select("appid"), "appid", "left_semi").isEmpty():
        raise RuntimeError("games of the batch are still queued")
    return state | {"status": "ABANDONED"}


def run_refresh(state: dict, rows: int, now: datetime, train: tuple[bool, str], actions: dict[str, Callable[[], None]]) -> dict:
    """The state after a refresh of the published base: reports follow if its rows changed, training if it is due.

    actions: snapshot, analytics and training. Each step is in the state once it is done, so a run after a failure doesn't
    publish twice what is out already.
    """
    done = dict(state)
    for step in refresh_steps(rows, state.get("published_rows"), train[0]):
        actions[step]()
        if step == "analytics":
            done["published_rows"] = rows
        if step == "training":
            done |= {"trained_rows": rows, "trained_at": now.isoformat()}
    return done | {"last_run_at": now.isoformat(), "training_reason": train[1]}
