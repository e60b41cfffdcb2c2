"""Event envelopes: what a record becomes on its way to the log. Ids follow from the record, so sending twice is harmless.

Times are UTC, whatever the session's zone, as 2024-01-01T00:00:00+00:00, with microseconds only where there are some.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names that readers of the log know.
REVIEW_CREATED = "REVIEW_CREATED"
PLAYER_COUNT_SNAPSHOT = "PLAYER_COUNT_SNAPSHOT"
PLAYER_VERSION = 1


def iso(time: Column) -> Column:
    utc = F.to_utc_timestamp(time, F.current_timezone())
    micros = F.when(F.unix_micros(time) % 1_000_000 != 0, F.date_format(utc, ".SSSSSS")).otherwise("")
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), micros, F.lit("+00:00"))


def iso_of_epoch(seconds: Column) -> Column:
    """Null for what isn't a positive whole number."""
    whole = seconds.try_cast("long")
    return F.when(whole > 0, iso(F.timestamp_seconds(whole)))


def normalized(text: Column) -> Column:
    """Null unless the text is a time with a zone."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), iso(F.try_to_timestamp(trimmed)))


def review_event_id(appid: Column, recommendationid: Column) -> Column:
    return F.concat_ws(":", F.lit(REVIEW_CREATED), appid.cast("string"), F.trim(recommendationid))


def player_event_id(appid: Column, observed_at: Column) -> Column:
    """observed_at as normalized."""
    return F.concat_ws(":", F.lit(PLAYER_COUNT_SNAPSHOT), appid.cast("string"), observed_at)


def _judged(rows: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    return rows.withColumn("unfit", F.concat_ws(";", *(F.when(F.coalesce(broken, F.lit(True)), F.lit(what)) for what, broken in rules)))


def review_envelopes(polled: DataFrame, produced_at: str) -> DataFrame:
    """appid and review -> event_id, event_type, appid, event_time, produced_at, payload, and unfit: why it can't be sent, or ''."""
    key, at = F.col("review.recommendationid"), iso_of_epoch(F.col("review.timestamp_created"))
    rows = polled.select(
        review_event_id(F.col("appid"), key).alias("event_id"), F.lit(REVIEW_CREATED).alias("event_type"), "appid", at.alias("event_time"), F.lit(produced_at).alias("produced_at"), F.col("review").alias("payload")
    )
    return _judged(rows, [("recommendationid is required", F.length(F.trim("payload.recommendationid")) == 0), ("appid must be positive", F.col("appid") <= 0), ("timestamp_created must be a positive epoch", F.col("event_time").isNull())])


def player_envelopes(observed: DataFrame) -> DataFrame:
    """appid, player_count, observed_at and produced_at as text -> the envelope and unfit."""
    at, made = normalized(F.col("observed_at")), normalized(F.col("produced_at"))
    rows = observed.select(
        player_event_id(F.col("appid"), at).alias("event_id"), F.lit(PLAYER_COUNT_SNAPSHOT).alias("event_type"), F.lit(PLAYER_VERSION).alias("schema_version"), "appid",
        at.alias("event_time"), made.alias("produced_at"), F.struct("player_count").alias("payload"),
    )
    return _judged(rows, [("appid must be positive", F.col("appid") <= 0), ("player_count must not be negative", F.col("payload.player_count") < 0), ("observed_at must have a zone", F.col("event_time").isNull()), ("produced_at must have a zone", F.col("produced_at").isNull())])


def fit(envelopes: DataFrame) -> DataFrame:
    return envelopes.where("unfit = ''").drop("unfit")
