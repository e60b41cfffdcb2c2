"""Event streams: parse, classify, quarantine, deduplicate, enrich; sinks that may run a batch twice.

Frames have the shape of a message log: key, value (binary), topic, partition, offset, timestamp. Every function works
on batch and streaming frames alike. Nothing raises on bad input; it is classified.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinera.sources.schemas import PLAYER_EVENT, REVIEW_EVENT

_LOG = ("key", "topic", "partition", "offset", "timestamp")


def _parsed(log: DataFrame, schema: str, games: DataFrame) -> DataFrame:
    at = F.bitmap_bucket_number(F.col("appid").cast("long"))
    events = log.select(*_LOG, F.col("value").cast("string").alias("raw_value")).withColumn("key", F.col("key").cast("string"))
    events = events.withColumn("e", F.from_json("raw_value", schema)).select(*_LOG, "raw_value", "e.*")
    events = events.withColumns({"event_ts": F.try_to_timestamp("event_time"), "produced_ts": F.try_to_timestamp("produced_at")})
    found = events.withColumn("_place", F.bitmap_bit_position(F.col("appid").cast("long"))).join(F.broadcast(_known_ids(games)), at == F.col("_ids"), "left")
    byte = F.conv(F.hex(F.substring("_bits", F.expr("CAST(_place DIV 8 + 1 AS INT)"), F.lit(1))), 16, 10).cast("int")
    return found.withColumn("_byte", byte).withColumn("_known", F.when(F.expr("(shiftright(_byte, CAST(_place % 8 AS INT)) & 1) = 1"), True)).drop("_ids", "_bits", "_place", "_byte")


def _known_ids(games: DataFrame) -> DataFrame:
    """A row of 4 KB for each 32,768 ids among which a game is, with a bit an id: 150 KB for 1,200,000 games in a row.

    So a message finds whether its game is known where it is; neither are messages dealt out by id, of which the wrong
    ones are many alike, nor does the driver hold a row a game.
    """
    ids = games.select(F.col("appid").cast("long").alias("_id")).where("_id IS NOT NULL")
    return ids.groupBy(F.bitmap_bucket_number("_id").alias("_ids")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("_bits"))


def all_reasons(rules: Sequence[tuple[str, Column]]) -> Column:
    """Every rule that holds, in order, joined by ';'. A rule that is null doesn't hold."""
    return F.concat_ws(";", *(F.when(broken, F.lit(name)) for name, broken in rules))


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    out = F.when(rules[0][1], F.lit(rules[0][0]))
    for name, broken in rules[1:]:
        out = out.when(broken, F.lit(name))
    return out.otherwise(F.lit(""))


def _bad(column: Column, wrong: Column) -> Column:
    return column.isNull() | wrong


def review_events(log: DataFrame, games: DataFrame, event_type: str = "REVIEW_CREATED") -> DataFrame:
    """With error_reason: all that is wrong, '' if valid."""
    c, p = F.col, F.col("payload")
    rules = [
        ("MISSING_EVENT_ID", c("event_id").isNull()),
        ("UNSUPPORTED_EVENT_TYPE", c("event_type") != event_type),
        ("INVALID_APPID", _bad(c("appid"), c("appid") <= 0)),
        ("INVALID_EVENT_TIME", c("event_ts").isNull()),
        ("MISSING_PRODUCED_AT", c("produced_at").isNull()),
        ("MISSING_PAYLOAD", p.isNull()),
        ("INVALID_RECOMMENDATIONID", _bad(p["recommendationid"], F.length(F.trim(p["recommendationid"])) == 0)),
        ("MISSING_TIMESTAMP_CREATED", p["timestamp_created"].isNull()),
        ("MISSING_VOTED_UP", p["voted_up"].isNull()),
        ("UNKNOWN_APPID", c("_known").isNull()),
    ]
    return _parsed(log, REVIEW_EVENT, games).withColumn("error_reason", all_reasons(rules)).withColumn("event_date", F.to_date("event_ts")).drop("_known")


def player_events(log: DataFrame, games: DataFrame, event_type: str = "PLAYER_COUNT_SNAPSHOT", version: int = 1) -> DataFrame:
    """With error_reason: the first thing wrong, '' if valid."""
    c, p = F.col, F.col("payload")
    rules = [
        ("MISSING_EVENT_ID", c("event_id").isNull()),
        ("UNSUPPORTED_EVENT_TYPE", _bad(c("event_type"), c("event_type") != event_type)),
        ("UNSUPPORTED_SCHEMA_VERSION", _bad(c("schema_version"), c("schema_version") != version)),
        ("INVALID_APPID", _bad(c("appid"), c("appid") <= 0)),
        ("UNKNOWN_APPID", c("_known").isNull()),
        ("INVALID_PLAYER_COUNT", _bad(p["player_count"], p["player_count"] < 0)),
        ("INVALID_EVENT_TIME", c("event_ts").isNull()),
        ("INVALID_PRODUCED_AT", c("produced_ts").isNull()),
        ("KAFKA_KEY_APPID_MISMATCH", c("key").isNotNull() & ~F.trim("key").eqNullSafe(c("appid").cast("string"))),
    ]
    return _parsed(log, PLAYER_EVENT, games).withColumn("error_reason", first_reason(rules)).withColumn("event_date", F.to_date("event_ts")).drop("_known")


def archive(events: DataFrame) -> DataFrame:
    """Every event, valid or not, its payload as JSON again."""
    return events.select(*_LOG, "event_id", "event_type", "appid", "event_time", "produced_at", F.to_json("payload").alias("payload_json"), "raw_value", "event_date")


def quarantine(events: DataFrame) -> DataFrame:
    return events.where("error_reason <> ''").select(*_LOG, "raw_value", "error_reason", "event_date")


def valid(events: DataFrame) -> DataFrame:
    return events.where("error_reason = ''")


def once(events: DataFrame, key: Sequence[str], delay: str) -> DataFrame:
    """One event a key: the first within the watermark on a stream, on a batch the least by time and a hash of the row."""
    if events.isStreaming:
        return events.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(list(key))
    rest = [c for c in events.columns if c not in key]
    one = events.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct("event_ts", F.xxhash64(*rest))).alias("_r"))
    return one.select(*(F.col(c) if c in key else F.col("_r")[c].alias(c) for c in events.columns))


def review_rows(events: DataFrame, games: DataFrame) -> DataFrame:
    """Valid review events in the shape of landed reviews, for the batch cleaning."""
    names = games.select("appid", "game_name")
    return valid(events).select("appid", F.col("payload").alias("review"), "event_ts").join(names, "appid")


def player_silver(events: DataFrame, delay: str = "1 day") -> DataFrame:
    return once(valid(events), ["event_id"], delay).select("event_id", "appid", F.col("payload.player_count").alias("player_count"), F.col("event_ts").alias("observed_at"), F.col("produced_ts").alias("produced_at"), F.col("event_date").alias("observed_date"))


def player_gold(silver: DataFrame, games: DataFrame) -> DataFrame:
    return silver.join(games.select("appid", "game_name"), "appid").withColumn("observed_hour", F.date_trunc("hour", "observed_at"))


def without_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """rows whose key isn't in known, by a plain anti join that Spark sizes itself."""
    return rows.join(known.select(key).distinct(), key, "left_anti")


#: Keys that a stream keeps are on disk, with bounded memory a process; the default keeps them all in a heap. A stream
#: that goes on from a checkpoint keeps the store that it began with. What a batch has shuffled goes when the batch is
#: over, not when the driver happens to collect its garbage, and the state of two batches is kept, not of a hundred.
_STATE = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}


def _started(spark: SparkSession, writer, interval: str | None):
    """A query takes its session's settings when it starts; the session gets its own back.

    One that ends with what there is has few batches: a task's keys are read from the checkpoint again at each, and no
    copy of all keys stays on the executors' disks.
    """
    settings = _STATE if interval else _STATE | {"spark.sql.streaming.stateStore.unloadOnCommit": "true"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def file_sink(frame: DataFrame, path: str, checkpoint: str, partition: str | None = None, interval: str | None = None, compression: str = "snappy"):
    """Starts a Parquet sink; without an interval it takes what there is and ends."""
    writer = frame.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).option("compression", compression).outputMode("append")
    return _started(frame.sparkSession, writer.partitionBy(partition) if partition else writer, interval)


def _existing(spark: SparkSession, path: str, schema) -> DataFrame:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


#: Buckets of keys in a table that batches are appended to, or that they update.
KEY_BUCKETS = 64


def _bucket(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(KEY_BUCKETS)).cast("int")


def _touched(batch: DataFrame) -> list[int]:
    return [r[0] for r in batch.select("_bucket").distinct().collect()]  # KEY_BUCKETS at most


def append_once(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: appends rows whose key isn't there yet, so that a batch may run again.

    The table is partitioned by a bucket of the key, and of its rows only the keys of buckets that the batch touches are read.
    A batch adds a file a bucket, not one for each task and bucket, all of which the driver would list at every batch.
    """

    def write(batch: DataFrame, _: int) -> None:
        batch = batch.withColumn("_bucket", _bucket([key]))
        there = _existing(batch.sparkSession, path, batch.schema).where(F.col("_bucket").isin(_touched(batch))).select(key)
        batch.dropDuplicates([key]).join(there, key, "left_anti").repartition("_bucket").write.mode("append").partitionBy("_bucket").parquet(path)

    return write


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete snapshots, oldest first."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getParent().getName() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/*/_SUCCESS")) or [])


def newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot of a table that upsert_once() writes."""
    found = _folders(spark, path)
    if not found:
        raise LookupError(f"no snapshot in {path}")
    return spark.read.parquet(f"{path}/{found[-1]}")


def upsert_once(path: str, key: Sequence[str], order: Sequence[str], keep: int = 2) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: a keyed snapshot folder a batch; the newest complete one is the table, older than `keep` go.

    A batch builds on the newest snapshot but its own, whatever the numbers, so a batch that runs again and a stream whose
    checkpoint starts anew lose nothing. What goes, goes before the new one is written, so there are never more than
    `keep` (one at least) and the one in work.
    """
    from opinera.operators.snapshots import latest
    from opinera.sources.staging import drop_folder

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _folders(spark, path)
        own = f"{number:010d}"
        if before and own < before[-1]:  # a checkpoint that starts anew counts from 0
            own = f"{int(before[-1].split('-')[0]):010d}-{number:010d}"
        older = [b for b in before if b != own]
        for name in [b for b in older if b < own][: -max(keep, 1)]:
            drop_folder(spark, f"{path}/{name}")
        rows = latest(spark.read.schema(batch.schema).parquet(f"{path}/{older[-1]}").unionByName(batch), key, order) if older else latest(batch, key, order)
        rows.write.mode("overwrite").parquet(f"{path}/{own}")

    return write


def batch_sink(frame: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", interval: str | None = None):
    writer = frame.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode)
    return _started(frame.sparkSession, writer, interval)


def latest_players(silver: DataFrame) -> DataFrame:
    """The greatest row of each game by time and id; summed before the shuffle, so a hot game moves one row a task."""
    from opinera.operators.snapshots import latest

    return latest(silver, ["appid"], ["observed_at", "event_id"]).withColumn("observed_micros", F.unix_micros("observed_at"))
