"""Sinks as snapshot folds: each returns the new snapshot, and where useful the actions.

A Parquet table has no MERGE, so an upsert writes a new snapshot beside the one
it reads and swaps the pointer afterwards; ``write_snapshot`` does so.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def append(target: DataFrame, source: DataFrame, run: str) -> DataFrame:
    """Rows of both; the new ones stamped with the run, columns missing on a side null."""
    return target.unionByName(source.withColumn("data_source_id", F.lit(run)), allowMissingColumns=True)


def first_per_key(df: DataFrame, keys: list[str], *order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*(order or keys))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order=(), coalesce: bool = False) -> DataFrame:
    """Source rows replace target rows of equal keys; ``coalesce`` keeps target values where the source has null or ''."""
    source = first_per_key(source, keys, *order)
    value_columns = [c for c in target.columns if c not in keys]
    s = source.select(*keys, *[F.col(c).alias(f"s_{c}") for c in value_columns if c in source.columns], F.lit(True).alias("__new"))
    both = target.withColumn("__old", F.lit(True)).join(s, keys, "full_outer")

    def value(c):
        if c not in source.columns:
            return F.col(c)
        new = F.nullif(F.col(f"s_{c}"), F.lit("")) if coalesce and dict(target.dtypes)[c] == "string" else F.col(f"s_{c}")
        merged = F.coalesce(new, F.col(c)) if coalesce else new
        return F.when(F.col("__new"), merged).otherwise(F.col(c)).alias(c)

    action = F.when(F.col("__new") & F.col("__old").isNull(), "inserted").when(F.col("__new"), "updated").otherwise("kept")
    return both.select(*keys, *[value(c) for c in value_columns], action.alias("action"))


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str], order=(), when: str = "true") -> DataFrame:
    """Source rows whose keys no target row that meets ``when`` has; the first of a batch per key."""
    fresh = first_per_key(source.dropna(subset=keys), keys, *order)
    return fresh.join(target.filter(when).select(*keys).distinct(), keys, "left_anti")


def replace_by_key(target: DataFrame, source: DataFrame, key: str, values: list) -> DataFrame:
    """All rows of the given key values go, the source's come in; an empty source still clears them."""
    return target.filter(~F.col(key).isin(values) | F.col(key).isNull()).unionByName(source)


def fill_nulls(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Null or blank values are filled from the source, others never touched; ``filled`` lists the columns."""
    s = first_per_key(source, keys).select(*keys, *[F.col(c).alias(f"s_{c}") for c in columns])
    both = target.join(s, keys, "left")
    blank = lambda c: F.nullif(F.col(c).cast("string"), F.lit("")).isNull()
    filled = F.concat_ws(",", *[F.when(blank(c) & F.col(f"s_{c}").isNotNull(), F.lit(c)) for c in columns])
    rest = [c for c in target.columns if c not in columns]
    return both.select(*rest, *[F.when(blank(c), F.coalesce(f"s_{c}", c)).otherwise(F.col(c)).alias(c) for c in columns], filled.alias("filled"))


def diff_update(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """insert, update or unchanged per source key, with the columns that change to a non-null value."""
    columns = [c for c in source.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"t_{c}") for c in columns], F.lit(True).alias("__old"))
    both = source.join(t, keys, "left")
    changed = F.concat_ws(",", *[F.when(F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(f"t_{c}")), F.lit(c)) for c in columns])
    label = F.when(F.col("__old").isNull(), "insert").when(changed != "", "update").otherwise("unchanged")
    return both.select(*keys, label.alias("label"), changed.alias("changed"))


def sync_delete(target: DataFrame, source: DataFrame, keys: list[str], covered: str) -> tuple[DataFrame, DataFrame]:
    """(kept rows, warned rows): rows absent from the source go unless covered, and covered ones are warned about."""
    absent = target.join(source.select(*keys).distinct(), keys, "left_anti")
    warned = absent.filter(covered)
    return target.join(source.select(*keys).distinct(), keys, "left_semi").unionByName(warned), warned


def replace_children(parents: DataFrame, children: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The children of the given parents are replaced by the new rows."""
    return children.join(parents.select(key).distinct(), key, "left_anti").unionByName(new)


def reconcile_meetings(target: DataFrame, scraped: DataFrame, as_of: str) -> DataFrame:
    """Action per scraped meeting: update an exact match, upgrade a bare row of the day, or insert."""
    t = target.select("meeting_id", "body_id", "meeting_date", "agenda_url", "minutes_url")
    s = scraped.select("body_id", "meeting_date", F.col("agenda_url").alias("new_agenda"), F.col("minutes_url").alias("new_minutes"))
    exact = s.join(t.withColumnRenamed("agenda_url", "old_agenda").drop("minutes_url"), ["body_id", "meeting_date"]).filter(F.col("new_agenda").eqNullSafe(F.col("old_agenda")))
    exact = first_per_key(exact, ["body_id", "meeting_date", "new_agenda"], "meeting_id")
    hit = exact.select("body_id", "meeting_date", F.coalesce("new_agenda", F.lit("")).alias("k"), F.col("meeting_id").alias("exact_id"))
    bare = t.filter("agenda_url is null and minutes_url is null").groupBy("body_id", "meeting_date").agg(F.min("meeting_id").alias("bare_id"))
    rows = s.withColumn("k", F.coalesce("new_agenda", F.lit(""))).join(hit, ["body_id", "meeting_date", "k"], "left").join(bare, ["body_id", "meeting_date"], "left")
    upgrade = F.col("exact_id").isNull() & F.col("new_agenda").isNotNull() & F.col("bare_id").isNotNull()
    action = F.when(F.col("exact_id").isNotNull(), "update").when(upgrade, "upgrade").otherwise("insert")
    status = F.when(F.col("new_minutes").isNotNull(), "published").when(F.col("meeting_date") > F.lit(as_of).cast("date"), "agenda_published").otherwise("completed")
    return rows.select("body_id", "meeting_date", "new_agenda", action.alias("action"), F.when(action == "update", F.col("exact_id")).when(action == "upgrade", F.col("bare_id")).alias("meeting_id"), status.alias("status"))


def supersede_failures(failures: DataFrame, successes: DataFrame, keys: list[str], time: str) -> DataFrame:
    """A failure is resolved at the first later success of its keys: one ordered pass, no pairs."""
    marks = failures.withColumn("__ok", F.lit(None).cast(failures.schema[time].dataType)).withColumn("__s", F.lit(1))
    marks = marks.unionByName(successes.select(*keys, time, F.col(time).alias("__ok"), F.lit(0).alias("__s")), allowMissingColumns=True)
    later = Window.partitionBy(*keys).orderBy(F.desc(time), F.desc("__s")).rowsBetween(Window.unboundedPreceding, -1)
    return marks.withColumn("resolved_at", F.min("__ok").over(later)).filter("__s = 1").drop("__ok", "__s")


def write_snapshot(df: DataFrame, root: str) -> str:
    """Write a new snapshot directory beside the old ones and return its path; nothing that is read is overwritten."""
    path = f"{root}/snapshot-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return path
