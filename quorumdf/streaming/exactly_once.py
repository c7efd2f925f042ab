"""Streams that write through ``Snapshots``: each batch is one version, so a batch that runs again changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumdf.operators.snapshots import Snapshots

#: What an event of delivery says of an address; others say nothing.
DELIVERY = {"email.bounced": "undeliverable", "email.complained": "undeliverable", "email.delivered": "verified"}
STANCES = ["support", "oppose", "neutral"]

ACTIVITY = "jurisdiction_id long, dedupe_key string, ts timestamp, event_id long"
STATUS = "email string, status string, checked_at timestamp, event_id long"
ALERT = "email string, event_type string, ts timestamp, event_id long"
COMMENT = "comment_id long, user_id long, item_id long, stance string, ts timestamp"


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run what is there, batch by batch."""
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def milestones(snapshots: Snapshots) -> Callable[[DataFrame, int], None]:
    """Append milestones (ACTIVITY); of equal (jurisdiction_id, dedupe_key) only the first ever.

    Events without a key, and those of no jurisdiction, may repeat, as null equals nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.select("jurisdiction_id", "dedupe_key", "ts", "event_id")
        keyed = F.col("dedupe_key").isNotNull() & F.col("jurisdiction_id").isNotNull()
        first = Window.partitionBy("jurisdiction_id", "dedupe_key").orderBy("ts", "event_id")
        once = rows.filter(keyed).withColumn("rn", F.row_number().over(first)).filter("rn = 1").drop("rn")
        known = snapshots.table("activity", ACTIVITY).filter(keyed).select("jurisdiction_id", "dedupe_key")
        snapshots.publish(number, append={"activity": once.join(known, ["jurisdiction_id", "dedupe_key"], "left_anti").select(*rows.columns).unionByName(rows.filter(~keyed))})

    return write


def deliveries(snapshots: Snapshots) -> Callable[[DataFrame, int], None]:
    """Fold delivery events (email, event_type, ts, event_id) into the addresses' status, with an alert per worsening.

    The last event of an address decides: a delivery clears a bounce.  An alert is
    raised where an address turns undeliverable and was not so before; it is published
    with the status that it tells of.
    """

    def write(batch: DataFrame, number: int) -> None:
        table = F.create_map(*[F.lit(x) for kv in DELIVERY.items() for x in kv])
        email = F.lower(F.trim("email"))
        rows = batch.select(email.alias("email"), "event_type", "ts", "event_id").withColumn("status", F.try_element_at(table, F.col("event_type")))
        rows = rows.filter("status IS NOT NULL AND email <> ''")
        known = snapshots.table("status", STATUS)
        w = Window.partitionBy("email").orderBy("ts", "event_id")
        old = known.select("email", F.col("status").alias("was"))
        moved = rows.withColumn("before", F.lag("status").over(w)).join(old, "email", "left").withColumn("before", F.coalesce("before", "was"))
        alerts = moved.filter((F.col("status") == "undeliverable") & ~F.col("before").eqNullSafe("undeliverable")).select("email", "event_type", "ts", "event_id")
        last = rows.groupBy("email").agg(F.max(F.struct("ts", "event_id", "status")).alias("m"))
        new = last.select("email", "m.status", F.col("m.ts").alias("checked_at"), "m.event_id")
        snapshots.publish(number, replace={"status": new.unionByName(known.join(new, "email", "left_anti"))}, append={"alert": alerts})

    return write


def comments_until_cutoff(snapshots: Snapshots, items: DataFrame) -> Callable[[DataFrame, int], None]:
    """Accept comments (COMMENT) on ``items`` (item_id, cutoff) until the item's cutoff; reject the others with a reason.

    One comment per person and item: the first by time within a batch, and none where
    an earlier batch has accepted one.  Both tables change in one version.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.select("comment_id", "user_id", "item_id", F.lower(F.trim("stance")).alias("stance"), "ts")
        rows = rows.join(items.select("item_id", "cutoff"), "item_id", "left")
        reason = (
            F.when(F.coalesce(~F.col("stance").isin(STANCES), F.lit(True)), "stance")
            .when(F.col("cutoff").isNull(), "unknown item")
            .when(F.coalesce(F.col("ts") >= F.col("cutoff"), F.lit(True)), "closed")
        )
        rows = rows.withColumn("reason", reason)
        first = Window.partitionBy("user_id", "item_id", F.col("reason").isNull()).orderBy("ts", "comment_id")
        had = snapshots.table("accepted", COMMENT).select("user_id", "item_id", F.lit(True).alias("had"))
        rows = rows.withColumn("rn", F.row_number().over(first)).join(had, ["user_id", "item_id"], "left")
        again = F.col("reason").isNull() & ((F.col("rn") > 1) | F.col("had").isNotNull())
        rows = rows.withColumn("reason", F.when(again, "repeat").otherwise(F.col("reason")))
        columns = ["comment_id", "user_id", "item_id", "stance", "ts"]
        snapshots.publish(number, append={"accepted": rows.filter("reason IS NULL").select(columns), "rejected": rows.filter("reason IS NOT NULL").select(*columns, "reason")})

    return write


def tallies(accepted: DataFrame) -> DataFrame:
    """Stances per item."""
    return accepted.groupBy("item_id").agg(*[F.count_if(F.col("stance") == s).alias(s) for s in STANCES])
