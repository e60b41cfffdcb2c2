"""An onboarding batch: its manifest, what was staged for it, and what must hold before any of it is published."""

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinera.operators.quality import QualityError

SCHEMA_VERSION = 1
BATCH_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]*")


@dataclass(frozen=True)
class Manifest:
    batch_id: str
    games: tuple[tuple[int, str], ...]
    reviews_per_game: int
    policy_version: int = 1
    schema_version: int = SCHEMA_VERSION

    def __post_init__(self):
        ids = [i for i, _ in self.games]
        wrong = [
            what
            for what, broken in (
                (f"schema version {self.schema_version}", self.schema_version != SCHEMA_VERSION),
                (f"batch id {self.batch_id!r}", not BATCH_ID.fullmatch(self.batch_id)),
                ("the policy version must be positive", self.policy_version <= 0),
                ("the number of reviews must be positive", self.reviews_per_game <= 0),
                ("no games", not ids),
                ("repeated games", len(set(ids)) != len(ids)),
                ("games without an id or a name", any(i <= 0 or not n.strip() for i, n in self.games)),
            )
            if broken
        ]
        if wrong:
            raise QualityError(f"manifest: {'; '.join(wrong)}")

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.games), "appid int, name string")


def manifest_from_queue(batch_id: str, queue: DataFrame, registry: DataFrame, reviews_per_game: int, most: int) -> Manifest:
    """The queued games of the registry, by id; more than `most` raises rather than being cut."""
    rows = queue.join(registry.where("state = 'QUEUED'").select("appid"), "appid", "left_semi").select("appid", "name").orderBy("appid").limit(most + 1).collect()
    if len(rows) > most:
        raise QualityError(f"more than {most} queued games")
    return Manifest(batch_id, tuple((r["appid"], r["name"]) for r in rows), reviews_per_game)


def stage_metadata(manifest: DataFrame, probed: DataFrame) -> DataFrame:
    """The landed record of each game of the manifest, the first of repeated ones by a hash; a game without one raises."""
    rest = [c for c in probed.columns if c != "appid"]
    mine = probed.join(manifest.select("appid"), "appid", "left_semi")
    one = mine.groupBy("appid").agg(F.min_by(F.struct(*rest), F.xxhash64(*rest)).alias("r")).select("appid", "r.*")
    missing = manifest.join(one, "appid", "left_anti").select("appid").limit(5).collect()
    if missing:
        raise QualityError(f"no metadata of games {[r['appid'] for r in missing]}")
    return one


def findings(games: DataFrame, metadata: DataFrame, reviews: DataFrame, baseline: DataFrame, per_game: int) -> DataFrame:
    """rule, item: everything wrong with a staged batch.

    games: appid of the manifest. metadata: appid, success, name. reviews: file_appid (of the file's name), appid,
    recommendationid, language, voted_up. baseline: recommendationid that are published already.
    """
    text = lambda c: F.col(c).cast("string").alias("item")
    named = lambda rule, frame, item: frame.select(F.lit(rule).alias("rule"), text(item))
    blank = F.col("recommendationid").isNull() | (F.length(F.trim("recommendationid")) == 0)
    known = reviews.where(~blank).withColumn("recommendationid", F.trim("recommendationid"))
    per_id = known.groupBy("recommendationid").agg(F.count("*").alias("n"), F.count_distinct("file_appid").alias("files"))
    counts = known.groupBy("file_appid").agg(F.count_distinct("recommendationid").alias("n"))
    short = games.select(F.col("appid").alias("file_appid")).join(counts, "file_appid", "left").where(F.coalesce("n", F.lit(0)) != per_game)
    parts = [
        named("repeated metadata", metadata.groupBy("appid").count().where("count > 1"), "appid"),
        named("metadata that failed", metadata.where(~F.coalesce("success", F.lit(False))), "appid"),
        named("metadata without a name", metadata.where(F.col("name").isNull() | (F.length(F.trim("name")) == 0)), "appid"),
        named("missing metadata", games.join(metadata, "appid", "left_anti"), "appid"),
        named("unexpected metadata", metadata.join(games, "appid", "left_anti"), "appid"),
        named("missing review file", games.join(reviews.select(F.col("file_appid").alias("appid")), "appid", "left_anti"), "appid"),
        named("unexpected review file", reviews.select(F.col("file_appid").alias("appid")).distinct().join(games, "appid", "left_anti"), "appid"),
        named("review in another game's file", reviews.where(~F.col("appid").eqNullSafe(F.col("file_appid"))), "recommendationid"),
        named("review without an id", reviews.where(blank), "file_appid"),
        named("repeated review", per_id.where("n > files"), "recommendationid"),
        named("review of several games", per_id.where("files > 1"), "recommendationid"),
        named("review that isn't English", known.where(~F.col("language").eqNullSafe("english")), "recommendationid"),
        named("review without an opinion", known.where(F.col("voted_up").isNull()), "recommendationid"),
        named("review that is published", known.join(baseline.select("recommendationid"), "recommendationid", "left_semi").select("recommendationid").distinct(), "recommendationid"),
        named("wrong number of reviews", short, "file_appid"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def require_staged(found: DataFrame, most: int = 20) -> None:
    wrong = found.groupBy("rule").agg(F.count("*").alias("n"), F.min("item").alias("item")).orderBy("rule").limit(most).collect()
    if wrong:
        raise QualityError("; ".join(f"{r['rule']}: {r['n']}, such as {r['item']}" for r in wrong))


def collisions(manifest: DataFrame, published: DataFrame) -> DataFrame:
    """Games of the manifest that are published already."""
    return manifest.join(published.select("appid"), "appid", "left_semi")


def evidence_gaps(candidates: DataFrame, evidence: dict[str, DataFrame]) -> DataFrame:
    """kind, appid: candidates that a kind of evidence lacks, and evidence of games that are no candidates."""
    out = None
    for kind, rows in evidence.items():
        missing = candidates.join(rows, "appid", "left_anti").select(F.lit(f"no {kind}").alias("kind"), "appid")
        strange = rows.join(candidates, "appid", "left_anti").select(F.lit(f"{kind} of another").alias("kind"), "appid").distinct()
        both = missing.unionAll(strange)
        out = both if out is None else out.unionAll(both)
    if out is None:
        raise ValueError("no evidence to hold against the candidates")
    return out
