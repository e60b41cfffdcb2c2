"""Which items are let in, in what state they are, and when models and snapshots are due."""

import json
from dataclasses import dataclass
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: States, each before those it may become.
STATES = ("NEW", "QUALIFIED", "QUEUED", "ONBOARDING", "ACTIVE", "REJECTED")


@dataclass(frozen=True)
class Policy:
    app_type: str = "game"
    min_release_age_days: int = 30
    min_total_reviews: int = 500
    require_metadata: bool = True
    require_review_endpoint: bool = True
    min_playtime_minutes: int | None = None


def release_date(text: Column) -> Column:
    """Of the three written forms; null for others."""
    t = F.trim(text)
    return F.coalesce(*(F.to_date(F.try_to_timestamp(t, F.lit(f))) for f in ("yyyy-MM-dd", "d MMM, yyyy", "MMM d, yyyy")))


def qualify(games: DataFrame, policy: Policy, today: str) -> DataFrame:
    """games with release_age_days, reasons (every rule that fails) and qualified."""
    aged = games.withColumn("release_age_days", F.date_diff(F.lit(today).cast("date"), release_date(F.col("release_date"))))
    text = lambda v: F.lit(v).cast("string") if not isinstance(v, Column) else v.cast("string")
    failed = lambda broken, rule, expected, actual: F.when(broken, F.struct(F.lit(rule).alias("rule"), text(expected).alias("expected"), text(actual).alias("actual")))
    age, count = F.col("release_age_days"), F.expr("try_cast(total_reviews AS long)")
    rules = [
        failed(~F.col("app_type").eqNullSafe(policy.app_type), "INVALID_APP_TYPE", policy.app_type, F.col("app_type")),
        failed(age.isNull(), "INVALID_RELEASE_DATE", "valid release date", F.col("release_date")),
        failed(age < policy.min_release_age_days, "GAME_TOO_NEW", policy.min_release_age_days, age),
        failed(count.isNull() | (count < policy.min_total_reviews), "INSUFFICIENT_REVIEWS", policy.min_total_reviews, count),
    ]
    if policy.require_metadata:
        rules.append(failed(~F.col("metadata_available").eqNullSafe(True), "METADATA_UNAVAILABLE", "true", F.col("metadata_available")))
    if policy.require_review_endpoint:
        rules.append(failed(~F.col("review_endpoint_available").eqNullSafe(True), "REVIEW_ENDPOINT_UNAVAILABLE", "true", F.col("review_endpoint_available")))
    if policy.min_playtime_minutes is not None:
        played = F.expr("try_cast(playtime_minutes AS double)")
        rules += [failed(played.isNull(), "PLAYTIME_UNAVAILABLE", policy.min_playtime_minutes, F.lit(None)), failed(played < policy.min_playtime_minutes, "INSUFFICIENT_PLAYTIME", policy.min_playtime_minutes, played)]
    return aged.withColumn("reasons", F.array_compact(F.array(*rules))).withColumn("qualified", F.size("reasons") == 0)


def rejection_counts(qualified: DataFrame) -> DataFrame:
    return qualified.select(F.explode("reasons.rule").alias("rule")).groupBy("rule").agg(F.count("*").alias("games"))


def reconcile(registry: DataFrame, found: DataFrame) -> DataFrame:
    """registry (appid, state) after a qualification run (appid, qualified): new games enter, none is demoted."""
    both = registry.alias("r").join(found.alias("f"), "appid", "full_outer")
    entered = F.when(F.col("f.qualified"), F.lit("QUALIFIED")).otherwise(F.lit("REJECTED"))
    promoted = F.when(F.col("r.state").isin("NEW", "REJECTED") & F.coalesce("f.qualified", F.lit(False)), F.lit("QUALIFIED")).otherwise(F.col("r.state"))
    return both.select("appid", F.when(F.col("r.state").isNull(), entered).otherwise(promoted).alias("state"))


def capacity(registry: DataFrame, max_active: int, max_new: int) -> DataFrame:
    counts = registry.agg(*(F.count_if(F.col("state") == s).alias(s.lower()) for s in STATES))
    room = F.lit(max_active) - F.col("active") - F.col("onboarding") - F.col("queued")
    return counts.withColumn("capacity", F.greatest(F.lit(0), F.least(F.lit(max_new), room)))


def onboarding_plan(registry: DataFrame, room: int) -> DataFrame:
    """Qualified games by id: the first `room` are queued, the others deferred."""
    waiting = registry.where("state = 'QUALIFIED'").select("appid")
    chosen = waiting.orderBy("appid").limit(room).withColumn("_in", F.lit(True))
    return waiting.join(chosen, "appid", "left").select("appid", F.when(F.col("_in"), F.lit("QUEUED")).otherwise(F.lit("DEFERRED")).alias("action"))


def gates(games: DataFrame, evidence: dict[str, DataFrame]) -> DataFrame:
    """games with a flag for each kind of evidence that has their id, and ready if all do."""
    out = games
    for name, rows in evidence.items():
        out = out.join(rows.select("appid").distinct().withColumn(name, F.lit(True)), "appid", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    ready = F.lit(True)
    for name in evidence:
        ready = ready & F.col(name)
    return out.withColumn("ready", ready)


def merge_marks(old: DataFrame, new: DataFrame, key: str, mark: str) -> DataFrame:
    """High-water marks: never below what was there."""
    return old.unionByName(new).groupBy(key).agg(F.max(F.coalesce(F.col(mark), F.lit(0))).alias(mark))


def retrain(rows: int, now: datetime, trained_rows: int | None, trained_at: datetime | None, least_new: int = 1000, most_age: timedelta = timedelta(days=7)) -> tuple[bool, str]:
    """Whether to train, and why."""
    if trained_rows is None or trained_at is None:
        return True, "NO_PRIOR_TRAINING"
    if rows < trained_rows:
        raise ValueError("the snapshot has fewer rows than the last training")
    if trained_at > now:
        raise ValueError("the last training is in the future")
    new = rows - trained_rows
    if not new:
        return False, "NO_NEW_ROWS"
    if new >= least_new:
        return True, "ENOUGH_NEW_ROWS"
    return (True, "MODEL_AGE") if now - trained_at >= most_age else (False, "TOO_FEW_NEW_ROWS")


def fill_ranked(rows: DataFrame, key: str, order: list[Column], most: int) -> DataFrame:
    """The newest `most` rows of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


@dataclass(frozen=True)
class Plan:
    """A policy file: what is let in, how much at once, and how the catalog is read."""

    version: int
    qualification: Policy
    target_reviews_per_game: int
    max_new_games_per_cycle: int
    frequency: str
    refresh: bool
    page_size: int
    max_pages: int
    request_delay_seconds: float
    max_attempts: int
    exponential_backoff: bool


def _checked(values: dict, section: str, name: str, kind: type, least: float | None = None):
    value = values.get(name)
    right = isinstance(value, kind) if kind is bool else isinstance(value, (int, float) if kind is float else kind) and not isinstance(value, bool)
    if not right or (least is not None and value < least) or (kind is str and not value.strip()):
        raise ValueError(f"{section}.{name}: {value!r}")
    return value


def load_plan(path: str | Path) -> Plan:
    """Of a JSON file; anything missing or of another type or size is named."""
    try:
        root = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, json.JSONDecodeError) as error:
        raise ValueError(f"{path}: {error}") from error
    parts = {n: root.get(n) if isinstance(root, dict) else None for n in ("qualification", "onboarding", "discovery", "catalog_refresh", "retry")}
    if missing := sorted(n for n, p in parts.items() if not isinstance(p, dict)):
        raise ValueError(f"{path} lacks {missing}")
    of = lambda section, name, kind, least=None: _checked(parts[section], section, name, kind, least)
    played = parts["qualification"].get("min_playtime_minutes")
    rules = Policy(
        of("qualification", "app_type", str), of("qualification", "min_release_age_days", int, 0), of("qualification", "min_total_reviews", int, 0), of("qualification", "require_metadata", bool),
        of("qualification", "require_review_endpoint", bool), None if played is None else of("qualification", "min_playtime_minutes", int, 0),
    )
    return Plan(
        _checked(root, "policy", "version", int, 1), rules, of("onboarding", "target_reviews_per_game", int, 1), of("onboarding", "max_new_games_per_cycle", int, 1), of("discovery", "frequency", str).upper(),
        of("catalog_refresh", "enabled", bool), of("catalog_refresh", "page_size", int, 1), of("catalog_refresh", "max_pages", int, 1), of("catalog_refresh", "request_delay_seconds", float, 0), of("retry", "max_attempts", int, 1), of("retry", "exponential_backoff", bool),
    )


def partitioned(candidates: DataFrame, policy: Policy, today: str, order: str) -> DataFrame:
    """One row a candidate with outcome: QUALIFIED, REJECTED, or FAILED for ids that aren't positive, which all stay.

    Of a repeated id the first by `order` counts; repeats says how many others it had.
    """
    bad = ~F.coalesce(F.col("appid") > 0, F.lit(False))
    rest = [c for c in candidates.columns if c not in ("appid", order)]
    first = candidates.where(~bad).groupBy("appid").agg(F.min_by(F.struct(*rest, order), F.col(order)).alias("r"), (F.count("*") - 1).alias("repeats")).select("appid", "r.*", "repeats")
    judged = qualify(first, policy, today)
    judged = judged.withColumn("outcome", F.when(F.col("qualified"), F.lit("QUALIFIED")).otherwise(F.lit("REJECTED")))
    return judged.unionByName(candidates.where(bad).withColumns({"repeats": F.lit(0).cast("long"), "outcome": F.lit("FAILED")}), allowMissingColumns=True)


def queue_rows(queue: DataFrame, registry: DataFrame, target: int) -> DataFrame:
    """Every queued game of the registry once, under the queue's name for it or the registry's, with its target."""
    named = queue.groupBy("appid").agg(F.min("name").alias("_queued"))
    rows = registry.where("state = 'QUEUED'").join(named, "appid", "left")
    return rows.select("appid", F.coalesce(F.nullif(F.trim("_queued"), F.lit("")), "name").alias("name"), F.lit(target).alias("target_reviews"))
