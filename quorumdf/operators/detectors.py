"""Governance and data-quality detectors: finding rows from whole tables at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumdf.dealing import ROWS, parts

from .resolution import contained

# Words that mark staff, generic petitioners, titles of staff, forms of parcels and of street addresses.
STAFF_WORDS = ["director", "administrator", "attorney", "clerk", "manager", "engineer", "chief", "inspector", "coordinator", "secretary", "treasurer", "superintendent", "officer"]
GENERIC_PETITIONERS = ["staff", "resident", "applicant", "petitioner", "unknown", "n/a"]
STAFF_TITLES = [
    "director", "administrator", "attorney", "clerk", "manager", "engineer", "chief", "inspector", "coordinator", "secretary", "treasurer",
    "superintendent", "officer", "planner", "accountant", "auditor",
]
PARCEL = r"(?i)Parcel\s*(?:ID|No\.?|#)?\s*([A-Z]?\s?\d{2,4}[\s\-]\d{2,4}[A-Z]?)"
STREETS = "Lane|Ln|Street|St|Avenue|Ave|Road|Rd|Drive|Dr|Court|Ct|Way|Boulevard|Blvd|Circle|Cir|Place|Pl|Parkway|Pkwy|Highway|Hwy"
ADDRESS = rf"(?i)\b(\d{{1,5}}\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s+(?:{STREETS})\b)"
BUNDLE_TYPES = ["zoning_change", "ordinance"]
RECONSIDER_TYPES = BUNDLE_TYPES + ["resolution"]


def parcel_ids(title: Column) -> Column:
    """Normalised ids of the parcels and street addresses named in a text, distinct."""
    def named(kind, pattern):
        found = F.regexp_extract_all(title, F.lit(pattern), F.lit(1))
        return F.transform(found, lambda x: F.concat(F.lit(f"{kind}:"), F.upper(F.regexp_replace(F.trim(x), r"\s+", " "))))

    return F.array_distinct(F.concat(named("parcel", PARCEL), named("addr", ADDRESS)))


def unanimity_rate(motion: DataFrame) -> DataFrame:
    """Per body the share of unanimous motions with any tally, rated 1 to 3."""
    total = F.col("tally_yes") + F.col("tally_no") + F.col("tally_abstain")
    unanimous = (F.col("tally_yes") > 0) & (F.col("tally_no") == 0) & (F.col("tally_abstain") == 0)
    rated = motion.filter(total > 0).groupBy("body_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(unanimous).alias("unanimous"))
    rated = rated.filter("n >= 30").withColumn("pct", F.expr("(unanimous * 100) div n"))
    severity = (
        F.when((F.col("pct") >= 95) & (F.col("n") >= 100), 3).when((F.col("pct") >= 90) & (F.col("n") >= 50), 2).when(F.col("pct") >= 80, 1)
    )
    return rated.withColumn("severity", severity).filter("severity is not null")


def recusal_absence(vote: DataFrame) -> DataFrame:
    """Officials with more than 50 votes and no recusal for a conflict."""
    per = vote.groupBy("official_id").agg(
        F.count(F.lit(1)).alias("n_votes"), F.count_if(F.col("vote_value") == "conflict_recusal").alias("recusals"),
        F.min("body_id").alias("body_id"), F.datediff(F.max("motion_date"), F.min("motion_date")).alias("days"),
    ).filter("n_votes > 50 and recusals = 0")
    years = F.bround(F.col("days") / 365.25, 1)
    severity = F.when((F.col("n_votes") > 300) & (years >= 5), 3).when(F.col("n_votes") > 100, 2).otherwise(1)
    return per.select("official_id", "body_id", "n_votes", years.alias("years"), severity.alias("severity"))


def reconsidered_motion(motion: DataFrame) -> DataFrame:
    """Parcels that a body took up at least twice within 730 days."""
    rows = motion.filter(F.col("motion_type").isin(RECONSIDER_TYPES)).withColumn("parcel", F.explode(parcel_ids(F.col("title"))))
    per = rows.groupBy("body_id", "parcel").agg(
        F.count(F.lit(1)).alias("n"), F.min("motion_date").alias("first_date"), F.max("motion_date").alias("last_date"),
        F.sort_array(F.collect_list(F.struct("motion_date", "motion_id"))).alias("evidence"),
    )
    per = per.withColumn("span", F.datediff("last_date", "first_date")).filter("n >= 2 and span <= 730")
    severity = F.when((F.col("n") >= 3) & (F.col("span") <= 365), 3).when(F.col("span") <= 180, 2).otherwise(1)
    return per.withColumn("severity", severity)


def development_bundle(motion: DataFrame) -> DataFrame:
    """Meetings with three or more distinct parcels up for zoning or ordinance."""
    rows = motion.filter(F.col("motion_type").isin(BUNDLE_TYPES)).withColumn("parcel", F.explode(parcel_ids(F.col("title"))))
    per = rows.groupBy("meeting_id").agg(F.countDistinct("parcel").alias("n_parcels"), F.slice(F.array_sort(F.collect_set("parcel")), 1, 10).alias("samples"))
    severity = F.when(F.col("n_parcels") >= 5, 3).when(F.col("n_parcels") == 4, 2).otherwise(1)
    return per.filter("n_parcels >= 3").withColumn("severity", severity)


def staff_words() -> Column:
    """The staff words in the petitioner's name."""
    return F.filter(F.array(*map(F.lit, STAFF_WORDS)), lambda w: F.lower(F.col("petitioner")).contains(w))


def names_staff() -> Column:
    """Whether there is any staff word; unlike the list of them it is compiled."""
    return F.lower("petitioner").rlike("|".join(STAFF_WORDS))


def petitioner_is_staff(motion: DataFrame) -> DataFrame:
    return motion.filter(names_staff()).withColumn("matched", staff_words()).select("motion_id", F.array_join("matched", ",").alias("matched"), F.lit(2).alias("severity"))


def with_recorded(motion: DataFrame, vote: DataFrame) -> DataFrame:
    """Motions with the sum of their declared tally and the number of votes recorded."""
    declared = F.col("tally_yes") + F.col("tally_no") + F.col("tally_abstain")
    cast = vote.groupBy("motion_id").agg(F.count(F.lit(1)).alias("recorded"))
    return motion.withColumn("declared", declared).join(cast, "motion_id", "left").fillna(0, ["recorded"])


def tally_mismatch(motion: DataFrame, vote: DataFrame) -> DataFrame:
    """Declared totals that differ from the votes recorded; a null part of a tally excludes the motion."""
    rows = with_recorded(motion, vote).filter("declared > 0 and declared <> recorded")
    return rows.select("motion_id", "declared", "recorded")


def short_motion_title(motion: DataFrame) -> DataFrame:
    return motion.filter(F.length(F.trim("title")) < 10).select("motion_id", F.length(F.trim("title")).alias("title_length"), F.lit(1).alias("severity"))


def orphan_official(official: DataFrame, vote: DataFrame, term: DataFrame) -> DataFrame:
    """Elected officials with neither votes nor terms."""
    elected = official.filter("is_elected")
    return elected.join(vote.select("official_id"), "official_id", "left_anti").join(term.select("official_id"), "official_id", "left_anti").select("official_id")


def low_confidence_meeting(meeting: DataFrame) -> DataFrame:
    return meeting.filter(F.col("meta").ilike("%unavailable%")).select("meeting_id", "body_id")


def is_generic_petitioner() -> Column:
    low = F.lower(F.trim("petitioner"))
    return low.isin(GENERIC_PETITIONERS) | (F.length(low) < 3)


def generic_petitioner(motion: DataFrame) -> DataFrame:
    return motion.filter(is_generic_petitioner()).select("motion_id", F.lower(F.trim("petitioner")).alias("petitioner"), F.lit(1).alias("severity"))


def official_as_petitioner(motion: DataFrame, names: DataFrame, tasks: int = 1) -> DataFrame:
    """Petitioners that begin with a title and an official's name.

    An exact equi-rewrite of the prefix test: per distinct length of a candidate
    the petitioner's prefix is joined, so no pair is tried that cannot match.  The join
    goes to so many ``tasks`` at least, which the caller knows from the motions' number.
    """
    titles = F.array(*map(F.lit, ["councilmember ", "mayor ", "commissioner ", "city manager ", ""]))
    cand = names.select("official_id", F.explode(F.transform(titles, lambda t: F.concat(t, F.lower("canonical_name")))).alias("shape")).withColumn("len", F.length("shape"))
    lengths = cand.select("len").distinct()  # as many rows as a name has lengths, a few dozen
    pets = motion.filter("petitioner is not null").select("motion_id", F.lower("petitioner").alias("pet"))
    probes = pets.crossJoin(F.broadcast(lengths)).filter(F.length("pet") >= F.col("len")).withColumn("shape", F.substring("pet", F.lit(1), F.col("len")))
    n = max(tasks, parts(names, ROWS // 5))  # a name has five shapes
    found = probes.repartition(n, "shape").join(cand.repartition(n, "shape"), ["shape", "len"])
    return found.select("motion_id", "official_id").repartition(n, "motion_id").distinct()


#: What precedes an official's name in a petitioner that is one, and the part of the name that follows.
PETITIONER_SHAPES = [("councilmember ", "last_name"), ("councilmember ", "canonical_name"), ("mayor pro tem ", "canonical_name"), ("mayor ", "canonical_name")]


def elected_petitioners(motion: DataFrame, official: DataFrame) -> DataFrame:
    """(motion_id, official_id) of clean motions whose petitioner is an elected official.

    That is a name alone, or one that the petitioner begins with after a title.
    Only petitioners that begin with a title are cut to the lengths that names have, so
    the test for a beginning is an equi-join; a bare surname is never matched.
    """
    names = official.filter("is_elected").select("official_id", F.lower("canonical_name").alias("canonical_name"), F.lower("last_name").alias("last_name"))
    clean = motion.filter("data_status = 'clean' AND petitioner IS NOT NULL").select("motion_id", F.lower("petitioner").alias("pet"))
    whole = clean.join(names.select(F.col("canonical_name").alias("pet"), "official_id"), "pet").select("motion_id", "official_id")
    shapes = F.array(*[F.concat(F.lit(title), F.col(part)) for title, part in PETITIONER_SHAPES])
    begins = names.select("official_id", F.explode(F.array_distinct(F.array_compact(shapes))).alias("shape"))
    lengths = begins.select(F.length("shape").alias("len")).distinct().agg(F.collect_set("len").alias("lengths"))  # one row: names have a few dozen lengths
    titled = clean.filter(F.col("pet").startswith("councilmember ") | F.col("pet").startswith("mayor "))
    cuts = titled.crossJoin(F.broadcast(lengths)).select("motion_id", F.explode(F.transform(F.filter("lengths", lambda n: n <= F.length("pet")), lambda n: F.substring(F.col("pet"), F.lit(1), n))).alias("shape"))
    return whole.unionByName(cuts.join(begins, "shape").select("motion_id", "official_id")).distinct()


def elected_recommenders(motion: DataFrame, official: DataFrame, least: int = 8) -> DataFrame:
    """(motion_id, official_id) of clean motions whose staff recommender names an elected official anywhere; names of so many letters count."""
    names = official.filter(F.col("is_elected") & (F.length("canonical_name") >= least)).select("official_id", F.lower("canonical_name").alias("name"))
    clean = motion.filter("data_status = 'clean' AND recommender IS NOT NULL").select("motion_id", F.lower("recommender").alias("low"))
    return clean.join(contained(clean, "low", names, "name"), "low").join(names, "name").select("motion_id", "official_id").distinct()


def staff_looking_official(official: DataFrame, term: DataFrame) -> DataFrame:
    titled = official.filter(F.col("canonical_name").rlike(rf"(?i)\b(?:{'|'.join(STAFF_TITLES)})\b"))
    return titled.join(term.select("official_id"), "official_id", "left_anti").select("official_id", "canonical_name")


def top_finding(findings: DataFrame, key: str = "motion_id") -> DataFrame:
    """Per key the finding of highest severity; ties go to the pattern that sorts first."""
    w = Window.partitionBy(key).orderBy(F.desc("severity"), "pattern_id")
    return findings.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def quarantine_counts(state: DataFrame) -> DataFrame:
    """Of what ``quarantine`` gives: motions flagged, motions cleared back to clean, and those left to repairs."""
    old, new = F.col("old_state"), F.col("new_state")
    return state.agg(
        F.count_if(new == "disputed").alias("quarantined"), F.count_if((new == "disputed") & (old != "disputed")).alias("newly"), F.count_if((old == "disputed") & (new == "clean")).alias("cleared"), F.count_if(new == "repairing").alias("repairing")
    )


def quarantine(motion: DataFrame, findings: DataFrame) -> DataFrame:
    """New state of the motions, from their ``old_state``: flagged ones become disputed, others clean, with the transition."""
    top = top_finding(findings).select("motion_id", "pattern_id", "severity")
    rows = motion.join(top, "motion_id", "left")
    new = (
        F.when(F.col("old_state") == "repairing", "repairing").when(F.col("pattern_id").isNotNull(), "disputed").otherwise("clean")
    )
    return rows.select("motion_id", "old_state", new.alias("new_state"), F.when(new == "disputed", F.col("pattern_id")).alias("reason"))


#: Detector registry: id -> (what marks a motion that ``with_recorded`` gives, severity).
MOTION_DETECTORS = {
    "qa_generic_petitioner": (is_generic_petitioner, 1),
    "qa_petitioner_is_staff": (names_staff, 2),
    "qa_short_motion_title": (lambda: F.length(F.trim("title")) < 10, 1),
    "qa_tally_mismatch": (lambda: (F.col("declared") > 0) & (F.col("declared") != F.col("recorded")), 2),
}


def run_detectors(civic, registry=None) -> DataFrame:
    """Findings of all registered detectors, each under its pattern's id, from one scan of the motions."""
    found = [
        F.when(marks(), F.struct(F.lit(severity).alias("severity"), F.lit(name).alias("pattern_id")))
        for name, (marks, severity) in sorted((registry or MOTION_DETECTORS).items())
    ]
    rows = with_recorded(civic.motion, civic.vote)
    # nulls go afterwards: functions over arrays aren't compiled, nor is what they are given
    return rows.select("motion_id", F.explode(F.array(*found)).alias("found")).filter("found is not null").select("motion_id", "found.*")
