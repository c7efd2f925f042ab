"""Runs of all patterns whose findings are replaced pattern by pattern.

Each pattern's findings are a table of their own in ``Snapshots``.  A run stages what
every pattern finds, also where that is nothing, and publishes all of it in one
version: readers see the findings of one run, never of two halves.  A pattern that
fails leaves its former findings as they are, and the others run on.

Findings with the same subject and severity may be staged as one row with their number
(``times``); readers get each of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumdf.dealing import ROWS

from . import detectors as D
from .resolution import similar_pairs
from .snapshots import Snapshots

SUBJECTS = ["motion_id", "official_id", "body_id", "meeting_id"]
FINDING = "pattern_id string, severity int, " + ", ".join(f"{s} long" for s in SUBJECTS)
_FOLDER = "finding-"
#: Findings that one row is made into at once.
PIECE = 4096


def as_findings(rows: DataFrame, pattern_id: str, severity: int | None = None) -> DataFrame:
    """Findings of a pattern from rows with any of the subjects, and with a severity unless one is given; a row may stand for several, ``times``."""
    columns = [(F.col(s) if s in rows.columns else F.lit(None)).cast("long").alias(s) for s in SUBJECTS + ["times"] * ("times" in rows.columns)]
    level = F.col("severity") if severity is None else F.lit(severity)
    return rows.select(F.lit(pattern_id).alias("pattern_id"), level.cast("int").alias("severity"), *columns)


def name_typos(official: DataFrame) -> DataFrame:
    """Officials whose names are nearly another's, the pair's first as the subject, and how many pairs those are per severity."""
    first = lambda t: F.lower(F.substring_index(t, " ", 1))
    pairs = similar_pairs(official, official, "official_id", "canonical_name", "official_id", "canonical_name", 0.4, ordered=True, alike=first, unlike=0.5, counted=True)
    level = F.when(F.col("similarity") > 0.7, 3).when(F.col("similarity") > 0.5, 2).otherwise(1)
    return pairs.groupBy(F.col("ka").alias("official_id"), level.alias("severity")).agg(F.sum("n").alias("times"))


#: Pattern -> function(civic) -> its findings.
PATTERNS: dict[str, Callable] = {
    "unanimity_rate": lambda c: as_findings(D.unanimity_rate(c.motion), "unanimity_rate"),
    "recusal_absence": lambda c: as_findings(D.recusal_absence(c.vote), "recusal_absence"),
    "reconsidered_motion": lambda c: as_findings(D.reconsidered_motion(c.motion), "reconsidered_motion"),
    "development_bundle": lambda c: as_findings(D.development_bundle(c.motion), "development_bundle"),
    "qa_official_name_typos": lambda c: as_findings(name_typos(c.official), "qa_official_name_typos"),
    "qa_orphan_official": lambda c: as_findings(D.orphan_official(c.official, c.vote, c.term), "qa_orphan_official", 1),
    "qa_low_confidence_meeting": lambda c: as_findings(D.low_confidence_meeting(c.meeting), "qa_low_confidence_meeting", 2),
    "qa_official_as_petitioner": lambda c: as_findings(D.elected_petitioners(c.petition, c.named_official), "qa_official_as_petitioner", 2),
    "qa_official_as_staff_recommender": lambda c: as_findings(D.elected_recommenders(c.petition, c.named_official), "qa_official_as_staff_recommender", 2),
}

#: Those of the patterns whose findings are about motions; what quarantines motions needs no others.
MOTION_PATTERNS = ["qa_official_as_petitioner", "qa_official_as_staff_recommender"]


def run_patterns(civic, snapshots: Snapshots, number: int, patterns: dict[str, Callable] | None = None, marks: dict | None = None) -> list[str]:
    """Run all patterns and publish their findings as version ``number``; the names of those that failed.

    Patterns that only mark motions (``detectors.MOTION_DETECTORS``) share one scan; if
    it fails, each of them is run alone.
    """
    staged, failed = {}, []
    marks = D.MOTION_DETECTORS if marks is None else marks

    def stage(name: str, make: Callable) -> bool:
        try:
            staged[_FOLDER + name] = snapshots.stage(_FOLDER + name, make(civic))
            return True
        except Exception:
            return False

    if marks:
        try:
            shared = snapshots.stage("shared-marks", D.run_detectors(civic, marks))
            rows = snapshots.spark.read.parquet(shared)
            for name in marks:
                staged[_FOLDER + name] = snapshots.stage(_FOLDER + name, as_findings(rows.filter(F.col("pattern_id") == name), name))
        except Exception:
            failed += [name for name in marks if not stage(name, lambda c, n=name: as_findings(D.run_detectors(c, {n: marks[n]}), n))]
    failed += [name for name, make in (PATTERNS if patterns is None else patterns).items() if not stage(name, make)]
    snapshots.publish(number, staged=staged)
    return sorted(failed)


def findings(snapshots: Snapshots) -> DataFrame:
    """The findings of all patterns in the newest version."""
    folders = [f for name, found in snapshots.latest()[1].items() if name.startswith(_FOLDER) for f in found]
    if not folders:
        return snapshots.spark.createDataFrame([], FINDING)
    rows = snapshots.spark.read.schema(f"{FINDING}, times long").parquet(*folders)
    return rows.filter("times IS NULL").drop("times").unionAll(_each(rows.filter("times > 0")))


def _each(rows: DataFrame) -> DataFrame:
    """Every row ``times`` times, in pieces dealt over tasks by the number of all."""
    n = rows.agg(F.sum("times").alias("n")).first().n or 0
    tasks = min(2000, max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // ROWS))
    pieces = rows.withColumn("done", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(PIECE).cast("long")))).repartition(tasks)
    return pieces.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(PIECE), F.col("times") - F.col("done"))))).drop("times", "done", "i")
