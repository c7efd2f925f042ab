"""Secret scans by corpus-wide ownership frequency, in DataFrame functions alone.

Method.  Every text is scanned for candidates: the base kinds of the contract
(``assign``, ``access``, ``hex``) and two kinds of the method's own (``opaque``,
long runs that mix digits and letters of both cases; ``key``, private key blocks).
The value of each candidate is hashed, and the hashes of the whole corpus are
grouped: by owner and repository, then by owner, then alone, each step combining
before it shuffles.  A value that several owners hold is an ``example`` that was
copied around; one that a single owner holds, in however many repositories, and
that looks like a credential is ``live``; the rest is ``unclear``.  Spans of the
method's own kinds are reported if they are live; base spans always are.

Matches have no positions in Spark.  The pieces between them do, by ``split`` with
the same pattern: running sums of the lengths of pieces and matches are the ends.

Skew.  Verdicts return to the mentions by two joins.  Hashes with over 1/``SHARE``
of all mentions are fewer than ``SHARE``, so they are broadcast; each of the others
has a share below that, so no task of the shuffled join is hot.

Defined results: null text is the empty text, which has no spans; null repositories
and owners are one repository and one owner; rows that repeat an id, or all columns,
are scanned each for itself; spans of one start are ordered by kind as listed; very
long texts are read whole; an empty table gives none.  Other columns are ignored,
whatever their names.  A value is known by its SHA-256; no text is ever shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, whole_text, written

#: Fixed patterns of the contract, and two more; a span is the whole match.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
OPAQUE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KEY = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\r\n]+"
KINDS = ["assign", "access", "hex", "opaque", "key"]
BASE = 3

#: From so many owners on, a value is an example.
EXAMPLE_OWNERS = 3
#: A credential has so many different characters.
LEAST_DISTINCT = 8
#: Fixed words of values that were written to be replaced.
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|change_me|your[_-]?(key|token|secret|password)|redacted|xxxx|0123456789|1234567890|abcdefgh"
#: Values with a larger share of all mentions than one in so many are broadcast.
SHARE = 1000
_BLOCK = 256


def _running_sums(lengths: Column) -> Column:
    """Sums up to each entry, in blocks, as an array can only be grown by copying it."""
    grow = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    total = lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x)
    blocks = F.when(F.size(lengths) > 0, F.transform(F.sequence(F.lit(1), F.size(lengths), F.lit(_BLOCK)), lambda i: F.slice(lengths, i, _BLOCK))).otherwise(F.array().cast("array<array<int>>"))
    before = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, b: grow(acc, total(b)))
    within = F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda b, s: F.slice(F.aggregate(b, F.array(s), grow), F.lit(2), F.size(b)))
    return F.flatten(within)


def _with_found(df: DataFrame, kind: int, pattern: str, value=None, keep=None, gate: str | None = None) -> DataFrame:
    """Add ``found<kind>``: struct(start, kind, end, value) of every kept match, in the order of the text.

    ``gate`` is a plainer pattern that every match contains; texts without it are not searched.
    """
    m, p, e, out = f"m{kind}", f"p{kind}", f"e{kind}", f"found{kind}"
    none = F.array().cast("array<string>")
    there = F.col("text").rlike(gate or pattern)
    df = df.withColumn(m, F.when(there, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(p, F.when(F.size(m) > 0, F.split("text", pattern, -1)).otherwise(none))
    # the piece behind the last match has no match beside it
    df = df.withColumn(p, F.zip_with(F.col(m), F.slice(F.col(p), F.lit(1), F.size(m)), lambda x, y: F.length(x) + F.length(y)))
    df = df.withColumn(e, _running_sums(F.col(p)))
    one = lambda x, end: F.struct((end - F.length(x)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), (value(x) if value else x).alias("value"))
    df = df.withColumn(out, F.zip_with(F.col(m), F.col(e), one))
    if keep is not None:
        df = df.withColumn(out, F.filter(out, lambda s: keep(s["value"])))
    return df.drop(m, p, e)


def looks_live(value: Column) -> Column:
    """Many different characters, letters and digits, and no placeholder's words."""
    distinct = F.size(F.array_distinct(F.split(value, "")))
    return (distinct >= LEAST_DISTINCT) & value.rlike("[A-Za-z]") & value.rlike("[0-9]") & ~value.rlike(PLACEHOLDER)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None) -> DataFrame:
    """One row per document: doc_id, repo, owner, ``found``: struct(start, kind, end, hash, looks) ordered by start and kind."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        whole_text(text_col).alias("text"),
        (F.lit(None).cast("string") if repo is None else repo.cast("string")).alias("repo"),
        (F.lit(None).cast("string") if owner is None else owner.cast("string")).alias("owner"),
    )
    rows = _with_found(rows, 0, ASSIGN, lambda x: F.regexp_extract(x, ASSIGN, 2), lambda v: F.length(v) >= 12, gate=r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]")
    rows = _with_found(rows, 1, ACCESS, gate="AKIA")
    rows = _with_found(rows, 2, HEX)
    rows = _with_found(rows, 3, OPAQUE, keep=lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]"))
    rows = _with_found(rows, 4, KEY, gate="PRIVATE KEY-----")
    found = F.sort_array(reduce(F.concat, [F.col(f"found{k}") for k in range(len(KINDS))]))
    hashed = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.unhex(F.sha2(s["value"], 256)).alias("hash"), looks_live(s["value"]).alias("looks")))
    return rows.select("doc_id", "repo", "owner", hashed.alias("found"))


def ownership(mentions: DataFrame) -> DataFrame:
    """hash, mentions, n_repos, n_owners of every value, from rows (hash, repo, owner)."""
    per_repo = mentions.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("mentions"))
    per_owner = per_repo.groupBy("hash", "owner").agg(F.sum("mentions").alias("mentions"), F.count(F.lit(1)).alias("n_repos"))
    return per_owner.groupBy("hash").agg(F.sum("mentions").alias("mentions"), F.sum("n_repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def verdict(owners: Column, looks: Column, example_owners: int = EXAMPLE_OWNERS) -> Column:
    return F.when(owners >= example_owners, "example").when((owners == 1) & looks, "live").otherwise("unclear")


def with_ownership(mentions: DataFrame, share: int = SHARE) -> DataFrame:
    """Mentions with n_repos and n_owners of their values; no key of the shuffled join has over one in ``share`` of the rows."""
    values = written(ownership(mentions), "secret-values")
    most = (values.agg(F.sum("mentions").alias("n")).first().n or 0) / share
    often = values.filter(F.col("mentions") > most).select("hash", F.struct("n_repos", "n_owners").alias("often"))  # fewer than ``share`` rows
    rare = values.filter(F.col("mentions") <= most).select("hash", F.struct("n_repos", "n_owners").alias("rare"))
    rows = mentions.join(F.broadcast(often), "hash", "left")
    hot = rows.filter("often IS NOT NULL").select(*mentions.columns, "often.*")
    cool = rows.filter("often IS NULL").drop("often").join(rare, "hash").select(*mentions.columns, "rare.*")
    return hot.unionByName(cool)


def _as_text(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """One row per document: doc_id, ``base`` and ``spans`` (struct(start, kind, end, verdict) of reported ones), counts of verdicts."""
    found = candidates(docs, id_col, text_col, repo, owner).withColumn("row", F.monotonically_increasing_id())
    found = written(found, "secret-candidates")  # texts are left behind; row numbers are fixed
    mentions = found.select("row", "repo", "owner", F.explode("found").alias("s")).select("row", "repo", "owner", "s.*")
    judged = with_ownership(mentions).withColumn("verdict", verdict(F.col("n_owners"), F.col("looks"), example_owners))
    span = F.struct("start", "kind", "end", "verdict", "n_owners", "n_repos")
    reported = F.collect_list(F.when((F.col("kind") < BASE) | (F.col("verdict") == "live"), span))  # those of one document
    per_row = judged.groupBy("row").agg(F.sort_array(reported).alias("spans"), *[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "example", "unclear")])
    base = F.transform(F.filter("found", lambda s: s["kind"] < BASE), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    out = found.select("row", "doc_id", base.alias("base")).join(per_row, "row", "left").drop("row")
    empty = F.array().cast(per_row.schema["spans"].dataType)
    return out.withColumn("spans", F.coalesce("spans", empty)).fillna(0, ["n_live", "n_example", "n_unclear"])


def op11_secrets(spark, sf_dir: str) -> DataFrame:
    """An owner is a source; its repositories are its parts by language."""
    found = scan(table(spark, sf_dir, "documents"), repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.sha2(_as_text(F.col("base")), 256).alias("base_sha256"),
        _as_text(F.col("spans")).alias("spans"),
        "n_live",
        "n_example",
    )


def _sql_kind(kind: int, pattern: str, value: str = "m", keep: str = "true") -> str:
    quoted = pattern.replace("'", "''")
    return f"""SELECT rid, repo, owner, {kind} AS kind, e - length(m) AS s, e, {value} AS v FROM (
    SELECT *, sum(length(m) + length(p)) OVER (PARTITION BY rid ORDER BY i) AS e FROM (
    SELECT rid, repo, owner, unnest(ms) AS m, unnest(ps[:len(ms)]) AS p, unnest(range(len(ms))) AS i
    FROM (SELECT rid, repo, owner, regexp_extract_all(t, '{quoted}') AS ms, string_split_regex(t, '{quoted}') AS ps FROM d))) WHERE {keep}"""


_ANY_CASE = "|".join("".join(c if not c.isalpha() else f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_SQL_ASSIGN = ASSIGN.replace("(?i:(password|passwd|secret|token|api_?key))", f"({_ANY_CASE})")
_SQL_VALUE = "regexp_extract(m, '" + _SQL_ASSIGN.replace("'", "''") + "', 2)"
_SQL_TEXT = "coalesce(string_agg(CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' WHEN 3 THEN 'opaque' ELSE 'key' END || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (WHERE {}), '')"
OP11_SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, concat_ws('/', source, lang) AS repo, source AS owner FROM documents),
c AS ({" UNION ALL ".join([_sql_kind(0, _SQL_ASSIGN, _SQL_VALUE, "length(v) >= 12"), _sql_kind(1, "AKIA[A-Z0-9]+", keep="length(m) >= 18"), _sql_kind(2, "[0-9a-f]+", keep="length(m) >= 16"), _sql_kind(3, OPAQUE, keep="regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')"), _sql_kind(4, KEY)])}),
o AS (SELECT v, count(DISTINCT owner) + max(CAST(owner IS NULL AS INTEGER)) AS n_owners FROM c GROUP BY v),
j AS (SELECT c.*, CASE WHEN n_owners >= {EXAMPLE_OWNERS} THEN 'example' WHEN n_owners = 1 AND len(list_distinct(string_split(v, ''))) >= {LEAST_DISTINCT} AND regexp_matches(v, '[A-Za-z]') AND regexp_matches(v, '[0-9]') AND NOT regexp_matches(v, '{PLACEHOLDER}') THEN 'live' ELSE 'unclear' END AS verdict FROM c JOIN o USING (v))
SELECT d.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
sha256({_SQL_TEXT.format("kind < 3")}) AS base_sha256, {_SQL_TEXT.format("kind < 3 OR verdict = 'live'")} AS spans,
count(*) FILTER (WHERE verdict = 'live') AS n_live, count(*) FILTER (WHERE verdict = 'example') AS n_example FROM d LEFT JOIN j USING (rid) GROUP BY d.rid, d.doc_id"""
