"""Structured Streaming jobs over the event-shaped tables; batch and stream share their folds."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampNTZType

from quorumdf.operators.ledger import HOLD_MINUTES, RESERVATION, Account, fold_admission, fold_reservations


def scratch(spark: SparkSession) -> str:
    """The shared folder of the cluster; in local mode, as in tests, one of its own where none is set."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return path.rstrip("/") if path else tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """A file stream of one Parquet table; its folder is matched by name, so a single file is a stream, too."""
    schema = spark.read.parquet(path).schema
    folder, name = os.path.split(path.rstrip("/"))
    rows = spark.readStream.schema(schema).parquet(f"{folder}/{name}*")
    zoneless = [f.name for f in schema.fields if isinstance(f.dataType, TimestampNTZType)]
    return rows.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else rows  # watermarks want zoned time


def run_to_table(stream: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Run what is there through a stream into Parquet and return it.

    In update mode every batch is appended with its number, and the latest row per
    key is the table's state.
    """
    spark = stream.sparkSession
    root = f"{scratch(spark)}/stream-{uuid.uuid4().hex[:12]}"
    out = f"{root}/out"
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(out)

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.schema(StructType(stream.schema.fields + [StructField("batch", IntegerType())])).parquet(out)
    if not keys:
        return rows.drop("batch")
    columns = [c for c in stream.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch").alias("last")).select(*keys, "last.*")


def milestones_once(events: DataFrame, watermark: str = "30 days") -> DataFrame:
    """The first event per (jurisdiction, key) within the watermark."""
    keyed = events.select("ts", (F.col("user_id") % 5).alias("jurisdiction_id"), F.concat_ws(":", "event_type", (F.col("user_id") % 10).cast("string")).alias("key"))
    return keyed.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["jurisdiction_id", "key"]).select("jurisdiction_id", "key")


def health_by_window(events: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Extraction outcomes per day and method; late rows beyond the watermark are dropped."""
    method = F.when(F.col("event_id") % 3 == 0, "text").when(F.col("event_id") % 3 == 1, "ocr").otherwise("vision")
    rows = events.filter(F.col("event_type").isin("view", "click")).withWatermark("ts", watermark)
    per = rows.groupBy(F.window("ts", "1 day"), method.alias("method")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_id") % 7 == 0).alias("failed"))
    return per.select(F.col("window.start").alias("day"), "method", "n", "failed")


def failure_counts(events: DataFrame) -> DataFrame:
    """Running failures per (jurisdiction, job, step), in update mode."""
    e = events.filter("event_type = 'error'")
    return e.groupBy((F.col("user_id") % 5).alias("jurisdiction_id"), F.concat(F.lit("job"), (F.col("event_id") % 3).cast("string")).alias("job"), F.concat(F.lit("step"), (F.col("event_id") % 4).cast("string")).alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id")
    )


def contact_status(events: DataFrame) -> DataFrame:
    """Latest delivery event per user, in update mode."""
    return events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("m"), F.count(F.lit(1)).alias("n")).select("user_id", "n", F.col("m.event_type").alias("last_event"))


def comment_tallies(comments: DataFrame, items: DataFrame) -> DataFrame:
    """Stances per open item: a stream-static join, then an aggregation in update mode."""
    stance = F.when((F.col("conv_id") + F.col("turn")) % 3 == 0, "support").when((F.col("conv_id") + F.col("turn")) % 3 == 1, "oppose").otherwise("neutral")
    rows = comments.withColumn("item_id", F.expr("CAST(floor(conv_id / 10.0) AS BIGINT)")).withColumn("stance", stance).join(items, "item_id")
    return rows.groupBy("item_id").agg(*[F.count_if(F.col("stance") == s).alias(s) for s in ("support", "oppose", "neutral")])


def admission_stream(events: DataFrame, floor: int = 0) -> DataFrame:
    """The ledger's fold as a stateful stream keyed by account; events of a batch are taken in time order."""

    def step(key, frames, state: GroupState):
        held = dict(zip(("balance", "paused"), state.get)) if state.exists else None
        pdf = pd.concat(list(frames), ignore_index=True).sort_values(["ts", "event_id"])
        rows, held = fold_admission(pdf, floor, held)
        state.update((int(held["balance"]), bool(held["paused"])))
        yield pd.DataFrame(rows, columns=["event_id", "decision", "balance"])

    return events.groupBy("user_id").applyInPandasWithState(step, "event_id long, decision string, balance long", "balance long, paused boolean", "append", GroupStateTimeout.NoTimeout)


def reservation_stream(events: DataFrame, key: str, floor: int = 0, reserve: int = 0, watermark: str = "1 hour") -> DataFrame:
    """The reserve and settle fold as a stateful stream; a timer on the watermark reaps the holds of quiet accounts.

    Reaped holds come as rows without an event.
    """

    def step(who, frames, state: GroupState):
        held = json.loads(state.get[0]) if state.exists else None
        if state.hasTimedOut:
            account = Account(floor, reserve, held)
            n, held = account.reap(state.getCurrentWatermarkMs() / 6e4), account.state()
            rows = pd.DataFrame([(None, "reaped", account.balance, account.held, account.status)] * bool(n), columns=["event_id", "decision", "balance", "held", "status"])
        else:
            rows, held = fold_reservations(pd.concat(list(frames), ignore_index=True), floor, reserve, held)
        state.update((json.dumps(held),))
        if held["holds"]:
            due = int((held["holds"][0][2] + HOLD_MINUTES) * 6e4) + 60000
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield rows.astype({"event_id": "Int64"})

    rows = events.withWatermark("ts", watermark).groupBy(key)
    return rows.applyInPandasWithState(step, RESERVATION, "account string", "append", GroupStateTimeout.EventTimeTimeout)


def fund_events(events: DataFrame) -> DataFrame:
    """The ledger's rows of the events table, as in the civic view."""
    kind = F.when(F.col("event_type") == "purchase", "deposit").when(F.col("event_type") == "signup", "grant").otherwise("spend")
    sign = F.when(F.col("event_type").isin("purchase", "signup"), 1).otherwise(-1)
    return events.select("user_id", "event_id", "ts", kind.alias("kind"), (sign * (1 + F.round(F.col("value") * 100).cast("long") % 5000)).alias("amount_cents"))


def silent_sessions(events: DataFrame, gap: str = "36 hours", watermark: str = "1 day") -> DataFrame:
    """Activity sessions per user that a gap ends."""
    s = events.withWatermark("ts", watermark).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.col("session_window.start").alias("started"), F.col("session_window.end").alias("ended"), "n")
