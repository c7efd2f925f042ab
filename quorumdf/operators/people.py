"""Who is meant: names of minutes, rosters, filings and directories to officials, with what follows from it.

``officials`` has official_id, first_name, last_name, canonical_name and the
jurisdiction_id in which the official serves (null where none is known);
``alias`` has official_id and alias; ``terms`` official_id, term_id, start_date
and end_date (null while it lasts).  A null or empty name resolves to nobody.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumdf.functions import names as N

from .resolution import contained, similar_pairs
from .snapshots import settled

#: First day of a term whose real one isn't known.
PLACEHOLDER_START = "2020-01-01"


def _by_alias(alias: DataFrame) -> DataFrame:
    return alias.groupBy(F.lower("alias").alias("low")).agg(F.min("official_id").alias("found"))


def _covers(term: Column, day: Column) -> Column:
    return (term["start_date"] <= day) & (term["end_date"].isNull() | (term["end_date"] >= day))


def _seated(officials: DataFrame, terms: DataFrame) -> DataFrame:
    """One row per jurisdiction and surname: ``who`` of that name ever held a term, in order of ids, each with all terms."""
    held = officials.select("official_id", "jurisdiction_id", "first_name", F.lower("last_name").alias("low")).join(terms.select("official_id", "start_date", "end_date"), "official_id")
    one = held.groupBy("jurisdiction_id", "low", "official_id", "first_name").agg(F.collect_list(F.struct("start_date", "end_date")).alias("terms"))
    return one.groupBy("jurisdiction_id", "low").agg(F.sort_array(F.collect_list(F.struct("official_id", "first_name", "terms"))).alias("who"))


def _in_office(who: Column, day: Column) -> Column:
    """Of ``who`` those in office that day, else all of them: (official_id, first_name, active) each."""
    marked = F.transform(who, lambda w: F.struct(w["official_id"].alias("official_id"), w["first_name"].alias("first_name"), F.coalesce(F.exists(w["terms"], lambda t: _covers(t, day)), F.lit(False)).alias("active")))
    live = F.filter(marked, lambda w: w["active"])
    return F.when(F.size(live) > 0, live).otherwise(marked)


def surname_as_of(names: DataFrame, officials: DataFrame, terms: DataFrame) -> DataFrame:
    """Officials of the jurisdiction with the name's last word as surname: in office that day, else at any time.

    ``names`` has name, jurisdiction_id and as_of; one row per name and official.
    A name meets its officials in one row with all their terms, so no row per term is
    made and nothing is grouped again.
    """
    keys = ["name", "jurisdiction_id", "as_of"]
    asked = names.select(*keys).distinct().withColumn("low", F.lower(N.last_word(F.col("name"))))
    found = asked.join(_seated(officials, terms), ["jurisdiction_id", "low"])
    return found.select(*keys, F.inline(_in_office(F.col("who"), F.col("as_of"))))


def candidates(names: DataFrame, officials: DataFrame, alias: DataFrame, threshold: float = 0.65, top: int = 5) -> DataFrame:
    """name, official_id, similarity: the best of canonical name and aliases, so many of either kind per name."""
    asked = names.select("name").distinct()

    def best(rows):
        w = Window.partitionBy("name").orderBy(F.desc("similarity"), "official_id")
        return rows.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= top).drop("rn")

    own = similar_pairs(asked, officials, "name", "name", "official_id", "canonical_name", threshold)
    own = own.select(F.col("ka").alias("name"), F.col("kb").alias("official_id"), "similarity")
    other = similar_pairs(asked, alias.select("alias").distinct(), "name", "name", "alias", "alias", threshold)
    other = other.select(F.col("ka").alias("name"), F.col("kb").alias("alias"), "similarity").join(alias, "alias")
    other = other.groupBy("name", "official_id").agg(F.max("similarity").alias("similarity"))
    return best(own).unionByName(best(other)).groupBy("name", "official_id").agg(F.max("similarity").alias("similarity"))


def resolve_for_meeting(names: DataFrame, officials: DataFrame, alias: DataFrame, terms: DataFrame, threshold: float = 0.75) -> DataFrame:
    """official_id and matched_via of each (name, jurisdiction_id, as_of).

    In order: alias; alias without titles; the surname in office that day (or
    ever), if one alone has it, else told apart by the first initial; the most
    similar name of the jurisdiction.  Several of one surname that the initial
    doesn't tell apart are "ambiguous" and nobody.
    """
    keys = ["name", "jurisdiction_id", "as_of"]
    asked = settled(names.select(*keys).distinct())
    low = _by_alias(alias)
    named = asked.select("name").distinct().withColumn("plain", N.strip_title(F.col("name"))).withColumn("low", F.lower(N.last_word(F.col("plain"))))
    named = named.join(low.withColumnsRenamed({"low": "low1", "found": "f1"}), F.lower("name") == F.col("low1"), "left")
    named = named.join(low.withColumnsRenamed({"low": "low2", "found": "f2"}), F.lower("plain") == F.col("low2"), "left")
    via = F.when(F.col("f1").isNotNull(), "alias").when(F.col("f2").isNotNull(), "stripped")
    named = settled(named.select("name", "plain", "low", F.coalesce("f1", "f2").alias("official_id"), via.alias("matched_via")))
    surnames = settled(_seated(officials, terms))

    # whom a name resembles depends on the jurisdiction, but not on the day
    rest = asked.select("name", "jurisdiction_id").distinct().join(named.filter("matched_via is null and plain is not null"), "name").join(surnames, ["jurisdiction_id", "low"], "left_anti")
    rest = settled(rest.select(F.col("plain").alias("name"), "jurisdiction_id").distinct())
    near = candidates(rest, officials, alias, max(threshold, 0.65)).filter(F.col("similarity") >= threshold)
    seated = officials.join(terms.select("official_id"), "official_id", "left_semi").select("official_id", "jurisdiction_id")
    near = rest.join(near, "name").join(seated, ["official_id", "jurisdiction_id"])
    near = near.groupBy(F.col("name").alias("plain"), "jurisdiction_id").agg(F.max_by("official_id", F.struct("similarity", -F.col("official_id"))).alias("near_id"))
    near = named.filter("matched_via is null").select("name", "plain").join(near, "plain").select("name", "jurisdiction_id", "near_id")

    rows = asked.join(named, "name", "left").join(near, ["name", "jurisdiction_id"], "left").join(surnames, ["jurisdiction_id", "low"], "left")
    same = _in_office(F.col("who"), F.col("as_of"))
    rows = rows.select(*keys, "plain", "official_id", "matched_via", "near_id", F.when(F.col("matched_via").isNull() & F.col("as_of").isNotNull(), same).alias("same"))
    initial = F.lower(F.substring("plain", 1, 1))
    hit = F.filter("same", lambda w: (F.size(N.words_of(F.col("plain"))) >= 2) & (initial == F.lower(F.substring(w["first_name"], 1, 1))))
    rows = rows.select(*keys, "official_id", "matched_via", "same", F.when(F.col("as_of").isNotNull(), F.col("near_id")).alias("near_id"), hit.alias("hit"))
    one, told = F.size("same") == 1, F.size("hit") == 1
    found = F.when(F.col("same").isNull(), F.col("near_id")).when(one, F.get("same", F.lit(0))["official_id"]).when(told, F.get("hit", F.lit(0))["official_id"])
    how = F.when(one, "surname").when(told, "initial").when(F.col("same").isNotNull(), "ambiguous").when(F.col("near_id").isNotNull(), "similar")
    return rows.select(*keys, F.coalesce("official_id", found).alias("official_id"), F.coalesce("matched_via", how, F.lit("none")).alias("matched_via"))


def new_aliases(resolved: DataFrame, officials: DataFrame, alias: DataFrame) -> DataFrame:
    """alias, official_id of the names to remember: unknown so far and not against the official's first name.

    Of several officials under one name the earliest meeting's stays, then the lower id.
    """
    rows = resolved.filter(F.col("official_id").isNotNull() & (F.col("matched_via") != "alias")).withColumn("low", F.lower("name"))
    rows = rows.join(alias.select(F.lower("alias").alias("low")), "low", "left_anti").join(officials.select("official_id", "first_name"), "official_id")
    rows = rows.filter(N.first_names_agree(N.split_name(N.strip_title(F.col("name")))["first"], F.col("first_name")))
    first = rows.groupBy("low").agg(F.min(F.struct("as_of", "official_id", "name")).alias("r"))
    return first.select(F.col("r.name").alias("alias"), F.col("r.official_id").alias("official_id"))


def roster_match(page: DataFrame, officials: DataFrame, alias: DataFrame, seats: DataFrame, threshold: float = 0.70) -> DataFrame:
    """Names of a body's page to its present members: by alias, else the most similar of the body; (name, body_id) each.

    ``seats`` has official_id and body_id of the present terms.
    """
    asked = page.select("name", "body_id").distinct().withColumn("plain", N.strip_title(F.col("name")))
    low = _by_alias(alias)
    hit = asked.join(low.withColumnsRenamed({"low": "low1", "found": "f1"}), F.lower("name") == F.col("low1"), "left")
    hit = hit.join(low.withColumnsRenamed({"low": "low2", "found": "f2"}), F.lower("plain") == F.col("low2"), "left")
    member = seats.select("official_id", "body_id").distinct()
    hit = hit.select("name", "body_id", F.coalesce("f1", "f2").alias("official_id")).join(member, ["official_id", "body_id"]).select("name", "body_id", "official_id", F.lit("alias").alias("matched_via"))
    rest = asked.join(hit, ["name", "body_id"], "left_anti")
    asking = rest.select(F.struct("name", "body_id").alias("who"), "plain", "body_id")
    seated = officials.select("official_id", "canonical_name").join(member, "official_id")
    near = similar_pairs(asking, seated, "who", "plain", "official_id", "canonical_name", threshold, within="body_id")
    near = near.select("ka.name", "ka.body_id", F.col("kb").alias("official_id"), "similarity")
    near = near.groupBy("name", "body_id").agg(F.max_by("official_id", F.struct("similarity", -F.col("official_id"))).alias("official_id")).withColumn("matched_via", F.lit("similar"))
    return asked.select("name", "body_id").join(hit.unionByName(near), ["name", "body_id"], "left")


def filer_match(names: DataFrame, officials: DataFrame, alias: DataFrame) -> DataFrame:
    """Filers to officials: alias, alias of first and last word, the only official of that first and last name."""
    words = N.words_of(F.col("name"))
    asked = names.select("name").distinct().withColumn("n", F.size(words)).withColumn("a", F.get(words, F.lit(0))).withColumn("z", N.last_word(F.col("name")))
    low = _by_alias(alias)
    rows = asked.join(low.withColumnsRenamed({"low": "low1", "found": "f1"}), F.lower("name") == F.col("low1"), "left")
    short = F.when(F.col("n") > 2, F.lower(F.concat_ws(" ", "a", "z")))
    rows = rows.join(low.withColumnsRenamed({"low": "low2", "found": "f2"}), short == F.col("low2"), "left")
    full = officials.groupBy(F.lower("first_name").alias("la"), F.lower("last_name").alias("lz")).agg(F.count(F.lit(1)).alias("k"), F.min("official_id").alias("f3")).filter("k = 1").drop("k")
    rows = rows.join(full, (F.col("n") >= 2) & (F.lower("a") == F.col("la")) & (F.lower("z") == F.col("lz")), "left")
    return rows.select("name", F.coalesce("f1", "f2", "f3").alias("official_id"))


def historical_officials(names: DataFrame, officials: DataFrame) -> DataFrame:
    """What to do with each person named in old payloads, keyed by the name they go by, the surname and the jurisdiction.

    One agreeing official: "known" under that very name, else "alias"; several:
    "ambiguous"; none: "create".  Unreadable names and bare surnames are left
    out; a person's longest name is shown, of equal lengths the first in order.
    Officials without a jurisdiction can be meant in any.
    """
    plain = F.trim(N.strip_title(F.col("name")))
    rows = names.filter(F.col("name").isNotNull() & ~N.looks_unresolvable(F.col("name"))).select("jurisdiction_id", plain.alias("shown")).distinct()
    rows = rows.withColumn("p", N.split_name(F.col("shown"))).withColumn("called", N.goes_by(F.col("p"))).filter("p.first is not null and p.last is not null and called <> ''")
    key = ["jurisdiction_id", "called", "low"]
    people = rows.groupBy("jurisdiction_id", F.lower("called").alias("called"), F.lower("p.last").alias("low")).agg(F.min_by("shown", F.struct(-F.length("shown"), F.col("shown"))).alias("canonical_name"))
    people = people.withColumn("p", N.split_name(F.col("canonical_name")))
    known = officials.select("official_id", F.col("jurisdiction_id").alias("home"), F.col("first_name").alias("o_first"), F.col("canonical_name").alias("o_name"), F.lower("last_name").alias("low"))
    agree = N.first_names_agree(F.col("p.first"), F.col("o_first")) | N.first_names_agree(N.goes_by(F.col("p")), F.col("o_first"))
    near = people.join(known, "low").filter((F.col("home").isNull() | (F.col("home") == F.col("jurisdiction_id"))) & agree)
    near = near.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("official_id").alias("official_id"), F.min("o_name").alias("o_name"))
    out = people.join(near, key, "left")
    same = F.lower(F.trim("o_name")) == F.lower(F.trim("canonical_name"))
    action = F.when(F.col("n").isNull(), "create").when(F.col("n") > 1, "ambiguous").when(same, "known").otherwise("alias")
    return out.select("jurisdiction_id", "canonical_name", F.col("p.first").alias("first_name"), F.col("p.middle").alias("middle_name"), F.col("p.last").alias("last_name"), action.alias("action"), F.when(F.col("n") == 1, F.col("official_id")).alias("official_id"))


def backfill_votes(items: DataFrame, motions: DataFrame, resolved: DataFrame, stored: DataFrame, terms: DataFrame) -> DataFrame:
    """Votes of payload items that aren't stored yet, with the term of that day.

    ``items`` has meeting_id, meeting_date, pos and item (title, votes, recusals);
    the meeting's motion of the same title takes them, of equal titles the
    latest.  ``resolved`` has name and official_id.  An official's first vote on
    a motion counts; who is named among the item's recusals has recused.
    """
    motion = motions.groupBy("meeting_id", "title").agg(F.max("motion_id").alias("motion_id"))
    rows = items.select("meeting_id", "meeting_date", "pos", F.trim("item.title").alias("title"), F.col("item.individual_votes").alias("votes"), F.col("item.recusals").alias("recusals")).join(motion, ["meeting_id", "title"])
    votes = rows.select("motion_id", "meeting_date", "pos", "recusals", F.posexplode("votes").alias("at", "v"))
    out = F.coalesce(F.exists("recusals", lambda r: r["name"] == F.col("v.name")), F.lit(False))
    note = F.when(out, F.coalesce(F.try_element_at(F.filter("recusals", lambda r: r["name"] == F.col("v.name")), F.lit(-1))["reason"], F.lit("recused (no reason given)")))
    votes = votes.select("motion_id", "meeting_date", "pos", "at", F.col("v.name").alias("name"), F.when(out, "conflict_recusal").otherwise(F.coalesce("v.vote", F.lit("yes"))).alias("vote_value"), note.alias("notes"))
    votes = votes.join(resolved.filter("official_id is not null").select("name", "official_id"), "name")
    first = votes.groupBy("motion_id", "official_id").agg(F.min(F.struct("pos", "at", "meeting_date", "vote_value", "notes")).alias("r"))
    new = first.select("motion_id", "official_id", "r.meeting_date", "r.vote_value", "r.notes").join(stored.select("motion_id", "official_id"), ["motion_id", "official_id"], "left_anti")
    # an official's terms in one row, so that the new votes are made once
    held = terms.groupBy("official_id").agg(F.collect_list(F.struct("start_date", "term_id", "end_date")).alias("held"))
    live = F.filter("held", lambda t: _covers(t, F.col("meeting_date")))
    term_id = F.array_max(F.transform(live, lambda t: F.struct(t["start_date"].alias("start_date"), t["term_id"].alias("term_id"))))["term_id"]
    return new.join(held, "official_id", "left").select("motion_id", "official_id", term_id.alias("term_id"), "vote_value", "notes")


def staff_stubs(recommended: DataFrame, officials: DataFrame, min_motions: int = 2) -> DataFrame:
    """Staff to create: persons named in recommender lines that hold no official's name, with all their lines.

    ``recommended`` has line and motion_date; a line counts from so many motions
    on.  Names of eight characters or more are looked for as substrings of the
    few lengths that names have.
    """
    lines = recommended.filter("line is not null").groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min("motion_date").alias("first_date"), F.max("motion_date").alias("last_date")).filter(F.col("n") >= min_motions)
    names = officials.filter(F.length("canonical_name") >= 8).select(F.lower("canonical_name").alias("name"))
    matched = contained(lines.select(F.lower("line").alias("low")), "low", names, "name").select("low").distinct()
    free = lines.withColumn("low", F.lower("line")).join(matched, "low", "left_anti").withColumn("p", N.recommender_name(F.col("line"))).filter("p is not null")
    return free.groupBy(F.col("p.first").alias("first_name"), F.col("p.last").alias("last_name")).agg(
        F.sum("n").alias("motions"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.array_join(F.sort_array(F.collect_set("line")), "; ").alias("lines")
    )


def staff_roster(entries: DataFrame) -> DataFrame:
    """One row per person of "Title First Last" entries: titles, meetings and dates; equal names in any case are one."""
    rows = entries.withColumn("p", N.staff_entry(F.col("entry")))
    return rows.groupBy(F.lower("p.first").alias("first_name"), F.lower("p.last").alias("last_name")).agg(
        F.array_join(F.sort_array(F.collect_set("p.title")), ", ").alias("titles"), F.sum("meetings").alias("meetings"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")
    )


def sync_staff(page: DataFrame, resolved: DataFrame, officials: DataFrame) -> DataFrame:
    """State after a directory page: created, enriched, departed or kept.

    ``page`` has name and title, ``resolved`` name and official_id, ``officials``
    also is_elected, is_active and display_title.  Who is listed is active, whether
    elected or not; staff who aren't listed depart, but not where the page is
    empty.  A listed name without a surname is left out.
    """
    seen = page.select("name", "title").distinct().join(resolved.select("name", "official_id"), "name", "left")
    listed = seen.filter("official_id is not null").groupBy("official_id").agg(F.max("title").alias("title"))
    any_seen = page.agg((F.count(F.lit(1)) > 0).alias("any_seen"))  # one row
    rows = officials.select("official_id", "canonical_name", "is_elected", "is_active", "display_title").join(listed.withColumn("here", F.lit(True)), "official_id", "left").crossJoin(F.broadcast(any_seen))
    leaves = F.col("any_seen") & ~F.col("is_elected") & F.col("is_active")
    action = F.when(F.col("here"), "enriched").when(leaves, "departed").otherwise("kept")
    old = rows.select(
        "official_id", "canonical_name", "is_elected", F.when(F.col("here"), True).when(leaves, False).otherwise(F.col("is_active")).alias("is_active"), F.coalesce("title", "display_title").alias("display_title"), action.alias("action")
    )
    new = seen.filter(F.col("official_id").isNull() & (F.trim("name") != "")).groupBy("name").agg(F.max("title").alias("title"))
    new = new.select(F.lit(None).cast("long").alias("official_id"), F.col("name").alias("canonical_name"), F.lit(False).alias("is_elected"), F.lit(True).alias("is_active"), F.col("title").alias("display_title"), F.lit("created").alias("action"))
    return old.unionByName(new)


def staff_aliases(synced: DataFrame) -> DataFrame:
    """Aliases of the created staff: the name, and the title before the name."""
    made = synced.filter("action = 'created'")
    both = F.array_distinct(F.filter(F.array("canonical_name", F.concat("display_title", F.lit(" "), "canonical_name")), lambda a: a.isNotNull()))
    return made.select("canonical_name", F.explode(both).alias("alias"))


def roster_terms(roster: DataFrame, alias: DataFrame, terms: DataFrame) -> DataFrame:
    """Terms after a roster page of (name, seat_id): kept, reopened, or inserted from the placeholder day on.

    The latest term of the official on the seat counts.  Who has no alias is a
    new official: official_id null, with an inserted term.
    """
    rows = roster.select("name", "seat_id").distinct().withColumn("low", F.lower("name")).join(_by_alias(alias), "low", "left").withColumnRenamed("found", "official_id")
    last = terms.groupBy("official_id", "seat_id").agg(F.max_by(F.struct("term_id", "start_date", "end_date"), F.struct("start_date", "term_id")).alias("t"))
    rows = rows.join(last, ["official_id", "seat_id"], "left")
    action = F.when(F.col("t").isNull(), "inserted").when(F.col("t.end_date").isNull(), "kept").otherwise("reopened")
    return rows.select("name", "seat_id", "official_id", F.col("t.term_id").alias("term_id"), F.coalesce("t.start_date", F.lit(PLACEHOLDER_START).cast("date")).alias("start_date"), action.alias("action"))


def bundles(directory: DataFrame, consolidated: dict[str, str] | None = None) -> DataFrame:
    """Governments that start with another one's bundle: fips, bundle_fips and the rule; without a target both are null.

    ``directory`` has state, kind (county, city, school_district), fips and name.
    Each row has its targets by name in order; the first that exists is taken, of
    equal names the highest fips.  ``consolidated`` names cities that are their
    county without saying so.
    """
    name = F.col("name")
    base = F.trim(F.regexp_replace(name, r" School District$", ""))
    county = F.trim(F.regexp_extract(name, r"(?i)^(.+?)\s+(?:County\s+)?(?:Consolidated\s+)?School District(?:\s+\d+)?\s*$", 1))
    target = lambda rule, kind, text: F.struct(F.lit(rule).alias("rule"), F.lit(kind).alias("t_kind"), text.alias("t_name"))
    school = F.array(
        target("county", "county", base), target("city", "city", F.when(base.endswith(" City"), F.regexp_replace(base, r" City$", ""))),
        target("base_county", "county", F.concat(base, F.lit(" County"))), target("numbered", "county", F.when(county != "", F.concat(county, F.lit(" County")))),
    )
    pieces = F.split(name, "-")
    tails = F.transform(F.sequence(F.lit(2), F.size(pieces)), lambda i: F.array_join(F.slice(pieces, i, F.size(pieces)), "-"))
    tails = F.when(F.size(pieces) > 1, tails).otherwise(F.array().cast("array<string>"))
    city = F.concat(F.array(target("same_name", "county", name)), F.transform(tails, lambda t: target("suffix", "county", t)))
    dependent = directory.filter("kind in ('school_district', 'city')")
    wanted = dependent.select("state", "kind", "fips", F.posexplode(F.when(F.col("kind") == "city", city).otherwise(school)).alias("at", "t")).select("state", "kind", "fips", "at", "t.*")
    towns = directory.filter("kind in ('county', 'city')").groupBy("state", F.col("kind").alias("t_kind"), F.col("name").alias("t_name")).agg(F.max("fips").alias("t_fips"))
    found = wanted.join(towns, ["state", "t_kind", "t_name"]).groupBy("state", "kind", "fips").agg(F.min(F.struct("at", "t_fips", "rule")).alias("r"))
    out = dependent.select("state", "kind", "fips", "name").join(found, ["state", "kind", "fips"], "left")
    fixed = reduce(lambda c, kv: c.when(F.col("fips") == kv[0], kv[1]), (consolidated or {}).items(), F.when(F.lit(False), None))
    own = F.when(F.col("kind") == "city", fixed)
    return out.select("state", "kind", "fips", "name", F.coalesce(own, "r.t_fips").alias("bundle_fips"), F.when(own.isNotNull(), "consolidated").otherwise(F.col("r.rule")).alias("rule"))
