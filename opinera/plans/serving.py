"""What clients ask for: reports over a batch snapshot and live reviews together, live reviews in pages, predictions.

Reports merge partial states, so a count, a share and an average are those of all rows. Live reviews that the snapshot
already has (by recommendationid) are left out first.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinera.functions.dimensions import by_member
from opinera.operators import ranking
from opinera.plans import reports
from opinera.plans.metrics import Report, approval, extreme, merged_with_provenance


class Serving:
    def __init__(self, base: DataFrame, live: DataFrame):
        self.base = base
        self.live = live.join(base.select("recommendationid"), "recommendationid", "left_anti")

    def _merged(self, report: Report, shape=lambda d: d) -> DataFrame:
        return merged_with_provenance(report, report.partial(shape(self.base)), report.partial(shape(self.live)))

    def games(self) -> DataFrame:
        """One row a game, under the greatest of its names."""
        return self._merged(Report(("appid",), (extreme("game_name", lambda: F.col("game_name"), "max"), *reports.BY_GAME.measures)))

    def top_games(self, limit: int = 10) -> DataFrame:
        return ranking.top(self.games(), [F.desc("recommendation_rate"), F.desc("review_count"), F.asc("appid")], limit)

    def playtime(self) -> DataFrame:
        return self._merged(reports.BY_BUCKET)

    def free_paid(self) -> DataFrame:
        """An item whose price type isn't known is UNKNOWN on either side."""
        return self._merged(reports.BY_TYPE, lambda d: d.withColumn("game_type", reports.game_type(F.col("is_free"))))

    def genres(self) -> DataFrame:
        """Either side's reviews are unique, and none is on both."""
        return self._merged(approval(("genre",), lambda: F.col("voted_up")), lambda d: by_member(d.select("voted_up", "genres"), F.col("genres"), "genre"))

    def platforms(self) -> DataFrame:
        return reports.by_platform(self.base)

    def categories(self) -> DataFrame:
        return reports.by_category(self.base, unique=True)

    def purchases(self) -> DataFrame:
        return reports.by_purchase(self.base)

    def reviews(self, number: int = 1, size: int = 20, appid: int | None = None) -> tuple[DataFrame, int]:
        """A page of live reviews, newest first, and how many there are."""
        rows = self.live if appid is None else self.live.where(F.col("appid") == appid)
        return ranking.page(rows, [F.desc("timestamp_created"), F.desc("recommendationid")], number, size), rows.count()

    def windows(self, appid: int | None = None) -> DataFrame:
        """Hourly counts of live reviews; LookupError for a game without any."""
        found = reports.window_metrics(self.live)
        if appid is not None:
            found = found.where(F.col("appid") == appid)
            if found.isEmpty():
                raise LookupError(f"no live reviews of {appid}")
        return found.orderBy(F.desc("window_start"), "appid")


def what_if_rows(row: DataFrame, options: dict[str, Sequence]) -> DataFrame:
    """A row, and once more for every other value of every attribute: what was changed, and to what."""
    types = dict(row.dtypes)
    out = row.select(F.lit(None).cast("string").alias("changed"), F.lit(None).cast("string").alias("value"), *row.columns)
    for name, values in options.items():
        column = F.explode(F.array(*(F.lit(v).cast(types[name]) for v in values)))
        more = row.withColumn("_new", column).where(~F.col("_new").eqNullSafe(F.col(name))).withColumn(name, F.col("_new"))
        out = out.unionByName(more.select(F.lit(name).alias("changed"), F.col("_new").cast("string").alias("value"), *row.columns))
    return out


def what_if_effects(scored: DataFrame, probability: str = "probability") -> DataFrame:
    """How far each change moves the probability of the row as it is, largest gain first."""
    now = scored.where("changed IS NULL").select(F.col(probability).alias("_now"))
    moved = scored.where("changed IS NOT NULL").join(F.broadcast(now))  # a single row
    return moved.select("changed", "value", (F.col(probability) - F.col("_now")).alias("delta")).orderBy(F.desc("delta"), "changed", "value")


def candidate_evidence(candidates: DataFrame, metadata: DataFrame, reviews: DataFrame) -> DataFrame:
    """candidates with what is known of them; of repeated ids, the row with the least content by a hash counts."""
    one = lambda d: d.groupBy("appid").agg(F.min_by(F.struct(*(c for c in d.columns if c != "appid")), F.xxhash64(*d.columns)).alias("r")).select("appid", "r.*")
    return one(candidates).join(one(metadata), "appid", "left").join(one(reviews), "appid", "left")


def sample_statistics(reviews: DataFrame) -> DataFrame:
    """Of polled reviews by game: counts, unlike ids, share, and whether both opinions occur."""
    found = approval(("appid",), lambda: F.col("voted_up")).over(reviews)
    ids = reviews.groupBy("appid").agg(F.count_distinct("recommendationid").alias("unique_reviews"))
    return found.join(ids, "appid").withColumn("both_classes", (F.col("positive_reviews") > 0) & (F.col("negative_reviews") > 0))


def active_scope(registry: DataFrame, most: int) -> list[int]:
    """Ids of active games in order; more than `most` raises rather than being cut."""
    ids = [r["appid"] for r in registry.where("state = 'ACTIVE'").select("appid").orderBy("appid").limit(most + 1).collect()]
    if len(ids) > most:
        raise ValueError(f"more than {most} active games")
    return ids
