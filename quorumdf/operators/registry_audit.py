"""Entries of a registry of jurisdictions: claims of absence, and the rules that entries break.

An entry is JSON text.  Who claims that something doesn't exist has to attest the
search: sections opened, queries run, a sibling record that parses, votes to refute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields with a vocabulary of their own name, wordings of absence, queries that count.
VOCABULARY_FIELDS = ["agenda_platform", "clerk_email_access", "records_intake", "verified", "confidence"]
ABSENCE = (
    r"(?i)not\s+published|not\s+posted|none\s+published|no\s+(online\s+)?(agendas?|minutes|email|custodian|records|comment)"
    r"|does\s+not\s+(publish|post)|empty\s+(agendas?|minutes)?\s*page|nothing\s+(posted|published)"
)
DOCUMENT_QUERY = r"(?i)agenda|minutes"
CHANNEL_QUERY = r"(?i)comment|records|custodian|email|clerk"
MIN_QUERIES = 3

ENTRY = (
    "struct<agenda_platform:string,clerk_email_access:string,records_intake:string,verified:string,confidence:string,records_custodian_email:string,"
    "verification:struct<structure_sweep:struct<sections_enumerated:array<variant>>,search_pass:struct<queries:array<string>,engine:string>,sibling_control:string,adversarial:string,session_date:string>>"
)


def _once(rows: DataFrame, *columns: Column) -> DataFrame:
    """The rows' own columns and others, which later expressions read as values: as a generator's output they are computed once a row."""
    return rows.select("*", F.inline(F.array(F.struct(*columns))))


def read_entries(entries: DataFrame, entry: str = "entry") -> DataFrame:
    """The entries' fields as ``e``, public comment and gaps beside it; ``readable`` is false where the text isn't an object."""
    get = lambda path, kind: F.try_variant_get("_v", path, kind)
    rows = _once(entries.drop("readable"), F.try_parse_json(entry).alias("_v"))
    rows = rows.withColumn("readable", F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)))
    comment = get("$.public_comment", "variant")
    dictlike = comment.isNull() | F.schema_of_variant(comment).startswith("OBJECT") | F.is_variant_null(comment)
    kept = [c for c in entries.columns if c not in (entry, "readable")]
    return _once(
        rows, get("$", ENTRY).alias("e"), F.coalesce(dictlike, F.lit(True)).alias("comment_object"),
        get("$.public_comment.channel", "string").alias("channel"), get("$.public_comment.recipient_email", "string").alias("recipient"),
        F.coalesce(get("$.notable_gaps", "array<variant>"), F.array().cast("array<variant>")).alias("gaps"),
    ).select(*kept, "readable", "e", "comment_object", "channel", "recipient", "gaps")


def _some(c: Column) -> Column:
    return F.coalesce(c != "", F.lit(False))


def claims() -> Column:
    """The claims of absence of an entry as read, in a fixed order."""
    gap = F.filter(F.transform("gaps", lambda g: F.when(F.schema_of_variant(g) == "STRING", F.try_variant_get(g, "$", "string"))), lambda g: F.coalesce(g.rlike(ABSENCE), F.lit(False)))
    single = F.array(
        *[F.when(F.col(f"e.{c}") == "none_found", F.lit(f"{c}=none_found")) for c in ("agenda_platform", "clerk_email_access")],
        F.when(~_some(F.col("e.records_custodian_email")), "records_custodian_email is null"),
        F.when(F.col("comment_object") & F.col("channel").isin("none_found", "in_person_only"), F.concat(F.lit("public_comment.channel="), "channel")),
        F.when(F.col("comment_object") & ~_some(F.col("recipient")), "public_comment.recipient_email is null"),
    )
    return F.concat(F.filter(single, lambda c: c.isNotNull()), F.transform(gap, lambda g: F.concat(F.lit("notable_gaps: "), F.substring(g, 1, 80))))


def audited(entries: DataFrame, vocabularies: dict[str, list[str]], strict: bool = True) -> DataFrame:
    """Entries with ``claims`` and ``errors``, the rules they break; none means that they pass.

    A vocabulary that is missing or empty allows every word.  Not ``strict``
    leaves the rules of attestation out.  What can't be read breaks the rule
    "readable" alone and claims nothing.
    """
    rows = read_entries(entries)
    rows = _once(rows.drop("claims"), F.when(F.col("readable"), claims()).otherwise(F.array().cast("array<string>")).alias("claims"))
    outside = lambda c, words: c.isNotNull() & ~c.isin(words) if words else F.lit(False)
    rules = {f"vocabulary({c})": outside(F.col(f"e.{c}"), vocabularies.get(c)) for c in VOCABULARY_FIELDS}
    rules["vocabulary(public_comment.channel)"] = F.col("comment_object") & outside(F.col("channel"), vocabularies.get("public_comment_channel"))
    if strict:
        said = F.size("claims") > 0
        sections, queries = F.col("e.verification.structure_sweep.sections_enumerated"), F.col("e.verification.search_pass.queries")
        link = lambda s: F.coalesce((F.schema_of_variant(s) == "STRING") & F.try_variant_get(s, "$", "string").startswith("http"), F.lit(False))
        swept = F.coalesce((F.size(sections) >= 1) & F.forall(sections, link), F.lit(False))
        enough = F.coalesce(F.size(queries) >= MIN_QUERIES, F.lit(False))
        asks = lambda pattern: F.coalesce(F.exists(queries, lambda q: q.rlike(pattern)), F.lit(False))
        rules |= {
            "structure_sweep": said & ~swept, "search_pass": said & ~enough, "document_query": said & enough & ~asks(DOCUMENT_QUERY), "channel_query": said & enough & ~asks(CHANNEL_QUERY),
            "search_engine": said & enough & ~_some(F.col("e.verification.search_pass.engine")), "sibling_control": said & ~_some(F.trim("e.verification.sibling_control")),
            "adversarial": said & (F.col("e.confidence") == "high") & ~_some(F.col("e.verification.adversarial")), "session_date": said & (F.col("e.verified") == "verified") & ~_some(F.col("e.verification.session_date")),
        }
    broken = F.filter(F.array(*[F.when(condition, rule) for rule, condition in rules.items()]), lambda r: r.isNotNull())
    kept = [c for c in entries.columns if c not in ("entry", "claims", "errors")]
    return rows.select(*kept, "claims", F.when(F.col("readable"), broken).otherwise(F.array(F.lit("readable"))).alias("errors"))


def violations(audit: DataFrame, *keys: str) -> DataFrame:
    """One row per entry and broken rule."""
    return audit.select(*keys, F.explode("errors").alias("rule"))


def totals(audit: DataFrame) -> DataFrame:
    """One row: entries, those that pass, those that fail, claims of absence."""
    failed = F.size("errors") > 0
    return audit.agg(F.count(F.lit(1)).alias("n"), F.count_if(~failed).alias("passed"), F.count_if(failed).alias("failed"), F.coalesce(F.sum(F.size("claims")), F.lit(0)).alias("n_claims"))
