"""Entity resolution of person names with joins in stages."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumdf.functions import names as N
from quorumdf.functions.automaton import Automaton

from .snapshots import settled

#: Texts of a block that one task compares with another block's: few, so that a few thousand texts already give every core some products.
POSTINGS = 512
#: From so many blocks on they grow instead, up to ``LARGEST`` texts: every block is sent to each product.
BLOCKS = 24
LARGEST = 8192
#: Below this threshold most of a text's grams would have to be indexed, and blocks of texts are compared instead.
DENSE = 0.5


def similar_pairs(left: DataFrame, right: DataFrame, key_l: str, text_l: str, key_r: str, text_r: str, threshold: float, ordered: bool = False, alike=None, within: str | None = None, unlike: float | None = None, counted: bool = False) -> DataFrame:
    """(ka, kb, similarity) of the pairs whose trigram similarity is at least the threshold, exactly.

    From ``DENSE`` on pairs are found by an index of couples of grams (``_by_couples``),
    which stand in one order, the rarest first; below it by comparing blocks
    (``_by_blocks``).  Where they are only ``counted``, a column ``n`` stands for ``kb``:
    of its sum per ``ka`` and similarity each row gives a part.

    Rows of one key and text are one row; ``ordered`` keeps pairs of rising keys.
    ``alike`` is a function of the text's column; a column of that name tells whether
    both texts give the same, and pairs that don't have to be more than ``unlike`` similar,
    too.  ``within`` is a column that both rows have to share.
    """
    same = left is right and (key_l, text_l) == (key_r, text_r)
    mark = (lambda t: F.coalesce(alike(t), F.lit(""))) if alike else (lambda t: F.lit(None).cast("string"))
    group = F.col(within).cast("string") if within else F.lit("")

    def grams(df, key, text):
        rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), group.alias("w")).distinct()
        return rows.select("k", "w", mark(F.col("t")).alias("m"), "t", N.trigrams(F.col("t")).alias("grams")).filter("size(grams) > 0 AND w IS NOT NULL")

    both = [grams(left, key_l, text_l)] + ([] if same else [grams(right, key_r, text_r)])
    if threshold < DENSE:
        counts = [left.count()] + ([] if same else [right.count()])
        found = _by_blocks(*both * (2 if same else 1), *counts * (2 if same else 1), threshold, unlike or 0, same, ordered, counted)
        return found.select("ka", "n" if counted else "kb", "similarity", *(["alike"] if alike else []))
    freq = reduce(DataFrame.unionAll, [rows.select(F.explode("grams").alias("gram")) for rows in both]).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rank = freq.select("gram", F.row_number().over(Window.orderBy("n", "gram")).alias("r"))  # three of 36 letters and digits or blanks: 51 thousand rows at most

    def ranked(rows):
        rows = rows.select("k", "w", "m", "t", F.explode("grams").alias("gram")).join(F.broadcast(rank), "gram")
        return rows.groupBy("k", "w", "m", "t").agg(F.sort_array(F.collect_list("r")).alias("g")).select("k", "w", "m", "g", F.size("g").alias("s"))

    sets = [ranked(rows) for rows in both] * (2 if same else 1)
    found = _by_couples(*sets, threshold, same, ordered)
    found = found.filter(F.col("alike") | (F.col("similarity") > unlike)) if unlike else found
    found = found.withColumn("n", F.lit(1).cast("long")) if counted else found
    return found.select("ka", "n" if counted else "kb", "similarity", *(["alike"] if alike else []))


def _by_couples(a: DataFrame, b: DataFrame, threshold: float, same: bool, ordered: bool) -> DataFrame:
    """Pairs by an index of couples of each text's rarest grams.

    Sets of sizes x and y with Jaccard >= t share at least o = ceil(t / (1 + t) * (x + y))
    grams, so the first two common ones lie within the first x - o + 2 of the one and
    y - o + 2 of the other.  Couples of these are indexed per size of the other set.  A
    pair is made at its first common couple alone, where sketches of 256 bits allow it.
    """
    sizes = lambda rows: F.broadcast(rows.agg(F.collect_set("s").alias("sizes")))  # noqa: E731  one row: texts have a few dozen sizes
    other = F.col("o")
    least = lambda x, y: F.ceil(F.lit(threshold / (1 + threshold)) * (x + y) - 1e-6).cast("int")

    def couples(rows, others, side):
        sketch = [F.expr(f"aggregate(g, 0L, (z, r) -> if(shiftright(r, 6) % 4 = {q}, z | shiftleft(1L, r % 64), z)) AS `{q}{side}`") for q in range(4)]
        carried = [F.col(c).alias(f"{c}{side}") for c in ("k", "w", "m", "g", "s")]
        rows = rows.crossJoin(sizes(others)).select("g", "s", *carried, *sketch, F.explode("sizes").alias("o"))
        s, t = F.col("s"), F.lit(threshold)
        rows = rows.filter((F.least(s, other) >= t * F.greatest(s, other) - 1e-6) & (least(s, other) <= F.least(s, other))).withColumn("need", F.least(least(s, other), F.lit(2)))
        rows = rows.withColumn("top", s - least(s, other) + F.col("need"))
        one = F.transform(F.sequence(F.lit(1), F.col("top")), lambda i: F.struct(i.alias("i"), i.alias("j")))
        two = F.flatten(F.transform(F.sequence(F.lit(1), F.col("top") - 1), lambda i: F.transform(F.sequence(i + 1, F.col("top")), lambda j: F.struct(i.alias("i"), j.alias("j")))))
        rows = rows.select("*", F.explode(F.when(F.col("need") == 1, one).otherwise(two)).alias("at"))
        x, y = (s, other) if side == "a" else (other, s)
        number = lambda c: c.cast("long")
        gram = lambda i: number(F.get("g", F.col(f"at.{i}") - 1))
        key = ((number(x) * 65536 + number(y)) * 65536 + gram("i")).alias("key")
        return rows.select(key, gram("j").cast("int").alias("second"), F.col("at.j").alias(f"p{side}"), *(c + side for c in ("k", "w", "m", "g", "s", "0", "1", "2", "3")))

    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.second") == F.col("y.second")) & (F.col("wa") == F.col("wb"))
    both = couples(a, b, "a").alias("x").join(couples(b, a, "b").alias("y"), on)
    if ordered:
        both = both.filter("ka < kb")
    total, need = F.col("sa") + F.col("sb"), least(F.col("sa"), F.col("sb"))
    differ = reduce(lambda p, q: p + q, [F.bit_count(F.col(f"{q}a").bitwiseXOR(F.col(f"{q}b"))) for q in range(4)])
    both = both.filter(differ <= total - 2 * need)
    shared = F.size(F.array_intersect("ga", "gb"))
    both = both.filter(shared >= need)
    first = F.size(F.array_intersect(F.slice("ga", F.lit(1), F.col("pa")), F.slice("gb", F.lit(1), F.col("pb")))) == F.least(need, F.lit(2))
    sim = F.round(shared / (total - shared), 6)
    return both.filter(first).select("ka", "kb", sim.alias("similarity"), (F.col("ma") == F.col("mb")).alias("alike")).filter(F.col("similarity") >= threshold)


def _by_blocks(a: DataFrame, b: DataFrame, most_a: int, most_b: int, threshold: float, unlike: float, same: bool, ordered: bool, counted: bool) -> DataFrame:
    """Pairs by the numbers of grams that blocks of texts share, every block with every other one once.

    Python gives one row per text of the left, similarity and block, with the list of the
    keys that are so similar, or their number ``n`` where they are only ``counted``; Spark
    makes them rows.  ``most_a`` and ``most_b`` are numbers of rows that the sides have at
    most.  Grams are numbered by their three letters alone, so no table of all grams is made.
    """
    half = same and ordered
    letter = lambda gram, i: F.ascii(F.substring(gram, i, 1))  # noqa: E731  a to z, digits and blanks

    def blocks(rows, most, side):
        n = max(1, -(-most // POSTINGS))
        n = n if n <= BLOCKS else max(BLOCKS, -(-most // LARGEST))
        numbers = F.transform("grams", lambda g: (letter(g, 1) * 128 + letter(g, 2)) * 128 + letter(g, 3))
        rows = rows.filter("k IS NOT NULL") if ordered else rows
        rows = rows.select("k", "w", "m", numbers.alias("g"), F.pmod(F.xxhash64("k", "t"), F.lit(n)).alias("block"))
        return n, rows.groupBy(F.col("block").alias(f"b{side}")).agg(F.collect_list(F.struct(*"kwmg")).alias("rows")).select(f"b{side}", *[F.col(f"rows.{c}").alias(f"{c}{side}") for c in "kwmg"])

    (n_a, left), (n_b, right) = blocks(a, most_a, "a"), blocks(b, most_b, "b")
    spark = a.sparkSession
    places = spark.range(n_a).select(F.col("id").alias("ba")).crossJoin(spark.range(n_b).select(F.col("id").alias("bb")))
    places = places.filter("ba <= bb") if half else places
    n = n_a * (n_a + 1) // 2 if half else n_a * n_b
    pairs = places.join(left, "ba").join(right, "bb").repartition(min(n, 2000))  # in turn: each product takes as long as another
    kind = [f.dataType.simpleString() for f in a.schema.fields + b.schema.fields if f.name == "k"]
    schema = f"ka {kind[0]}, similarity double, alike boolean, " + ("n long" if counted else f"kb array<{kind[1]}>")

    def products(batches):
        for rows in batches:
            for r in range(rows.num_rows):
                sides = [[rows.column(c + side)[r].values for c in "kwmg"] for side in "ab"]
                (wa, wb), (ma, mb) = (_codes(sides[0][c], sides[1][c]) for c in (1, 2))
                ranks = _codes(sides[0][0], sides[1][0], ranked=True) if ordered else [np.zeros(len(w), np.int64) for w in (wa, wb)]
                one, two = ([k, w, m, x, g] for (k, _, _, g), w, m, x in zip(sides, (wa, wb), (ma, mb), ranks))
                twice = half and rows.column("ba")[r].as_py() != rows.column("bb")[r].as_py()
                for x, y in [(one, two), (two, one)][: 1 + twice]:
                    yield from _product(x, y, threshold, unlike, ordered, counted)

    found = pairs.mapInArrow(products, schema)
    return found if counted else found.select("ka", F.explode("kb").alias("kb"), "similarity", "alike")


def _codes(a: pa.Array, b: pa.Array, ranked: bool = False) -> list[np.ndarray]:
    """Numbers of the values of both arrays, equal for equal values; nulls are -1, or in order of the values where they are ``ranked``."""
    both = pa.concat_arrays([a, b])
    numbers = pc.rank(both, tiebreaker="dense") if ranked else both.dictionary_encode().indices.fill_null(-1)
    return np.split(numbers.to_numpy(zero_copy_only=False).astype(np.int64), [len(a)])


def _product(one: list, two: list, threshold: float, unlike: float, ordered: bool, counted: bool):
    """Batches of ``_by_blocks`` for two blocks: each of the one's texts with all of the other's, or with those of greater rank where they are ``ordered``.

    A block is its keys, groups, marks, ranks and lists of grams.  Of the other block texts with equally many
    grams are taken at once, so a text's similarity to them is a number of shared grams.  A strip of texts adds up
    the rows that its grams have in a table of grams by those texts; what all of the strip have is added once.
    """
    for group in np.intersect1d(one[1], two[1]):
        (kx, sx, fx, mx, rx), (ky, sy, fy, my, ry) = (_texts(block, group) for block in (one, two))
        known = np.intersect1d(fx, fy)
        (px, ax), (py, ay) = (_places(known, f, s) for f, s in ((fx, sx), (fy, sy)))
        both = np.intersect1d(mx, my)
        same = len(both) == 1 and bool((mx == both).all() and (my == both).all())
        in_x, in_y = np.isin(mx, both), np.isin(my, both)
        most = int(sx.max())
        wide = max(64, min(2048, (1 << 26) // (len(known) + 1)))
        for size in np.unique(sy):
            of_size = np.flatnonzero(sy == size)
            ratio = np.arange(most + 1) / (np.arange(most + 1)[:, None] + size - np.minimum(np.arange(most + 1), size)).clip(1)
            ratio = np.floor(ratio * 1e6 + (0.5 + 1e-7)) / 1e6  # by the text's grams and those shared; halves are rounded up
            least_alike, least_other = (np.where(r.any(axis=1), r.argmax(axis=1), most + 1) for r in (ratio >= threshold, (ratio >= threshold) & (ratio > unlike)))
            for columns in np.split(of_size, range(wide, len(of_size), wide)):
                w = len(columns)
                at = np.full(len(sy), -1)
                at[columns] = np.arange(w)
                at = at[ay]
                table = np.zeros((len(known), w), np.uint8)
                table[py[at >= 0], at[at >= 0]] = 1
                keys, mark, rank, some_y = ky.take(pa.array(columns)), my[columns], ry[columns], np.flatnonzero(in_y[columns])
                tall = max(1, (1 << 18) // w)
                for lo in range(0, len(sx), tall):
                    n = min(tall, len(sx) - lo)
                    after = np.searchsorted(rank, rx[lo : lo + n], "right") if ordered else np.zeros(n, np.int64)
                    if after.min() == w:
                        continue
                    shared, turn = _shared(px, ax, lo, n, table, most)
                    rows = lo + turn
                    least = (least_alike if same else least_other)[sx[rows], None]
                    hit = shared >= least.astype(shared.dtype)
                    if ordered:
                        after = after[turn]
                        hit[:, : after.max()] &= np.arange(after.max()) >= after[:, None]
                    some_x = np.flatnonzero(in_x[rows])
                    if not same and len(some_x) and len(some_y):
                        i, j = np.nonzero(mx[rows[some_x], None] == mark[some_y])
                        i, j = some_x[i], some_y[j]
                        hit[i, j] = False
                        keep = (shared[i, j] >= least_alike[sx[rows[i]]]) & (j >= after[i] if ordered else True)
                        yield from _lists(i[keep], j[keep], shared[i[keep], j[keep]], True, rows, sx, kx, keys, ratio, counted)
                    at = np.flatnonzero(hit)
                    i = at // w
                    yield from _lists(i, at - i * w, shared.ravel()[at], same, rows, sx, kx, keys, ratio, counted)


def _lists(i: np.ndarray, j: np.ndarray, shared: np.ndarray, alike: bool, rows: np.ndarray, sx: np.ndarray, kx: pa.Array, keys: pa.Array, ratio: np.ndarray, counted: bool):
    """A batch of pairs (i, j) of a strip, in order of i: per text and number of shared grams the similarity and the others' keys, or how many there are."""
    if not len(i):
        return
    n = len(rows)
    number = np.bincount(shared * np.int64(n) + i)
    found = np.flatnonzero(number)
    number, which, value = number[found], rows[found % n], found // n
    if counted:
        last = pa.array(number)
    else:
        to = j[np.argsort(shared, kind="stable")]
        last = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(number)), pa.int32()), keys.take(pa.array(to)))
    yield pa.record_batch([kx.take(pa.array(which)), pa.array(ratio[sx[which], value]), pa.array(np.full(len(found), alike)), last], ["ka", "similarity", "alike", "n" if counted else "kb"])


def _shared(places: np.ndarray, texts: np.ndarray, lo: int, n: int, table: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of grams that ``n`` texts from ``lo`` on share with those of the table, and the order in which the texts stand there."""
    at = slice(*np.searchsorted(texts, [lo, lo + n]))
    p, row = places[at], texts[at] - lo
    common = np.bincount(p, minlength=len(table)) == n
    p, row = p[~common[p]], row[~common[p]]
    own = np.bincount(row, minlength=n)
    turn = np.argsort(-own, kind="stable")  # texts with more grams of their own come first
    place = np.empty(n, np.int64)
    place[turn] = np.arange(n)
    grams = np.zeros((own.max(), n), np.int64)
    grams[np.arange(len(p)) - (np.cumsum(own) - own)[row], place[row]] = p
    shared = np.empty((n, table.shape[1]), np.min_scalar_type(most + 1))
    shared[:] = table[common].sum(axis=0, dtype=shared.dtype)
    for j, g in enumerate(grams):
        some = g[: np.count_nonzero(own > j)]
        shared[: len(some)] += table.take(some, axis=0)
    return shared, turn


def _texts(block: list, group: int) -> tuple:
    """Keys, numbers of grams, all grams, marks and ranks of a block's texts of one group, in order of their ranks."""
    keys, groups, marks, ranks, grams = block
    at = np.flatnonzero(groups == group)
    at = at[np.argsort(ranks[at], kind="stable")]
    grams = grams.take(pa.array(at))
    return keys.take(pa.array(at)), np.diff(grams.offsets.to_numpy()).astype(np.int64), grams.flatten().to_numpy(), marks[at], ranks[at]


def _places(known: np.ndarray, grams: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts' grams that are known: their places among these, and the numbers of their texts."""
    at = np.searchsorted(known, grams)
    hit = np.append(known, -1)[at] == grams
    return at[hit], np.repeat(np.arange(len(size)), size)[hit]


#: Names of so many letters in all are sought by automata that every task builds; more of them by their first grams.
AUTOMATON_LETTERS = 2_000_000
#: Letters of one automaton: a table of about as many states by some dozens of letters.
TABLE_LETTERS = 100_000


def contained(texts: DataFrame, text: str, names: DataFrame, name: str, most: int = AUTOMATON_LETTERS) -> DataFrame:
    """(text, name) of distinct texts and the names that stand anywhere within them; both columns are compared as they are.

    Names of up to ``most`` letters in all are made into automata, and every text is read
    once by each of them: nothing but the results is made.  More names go by the index of
    ``contained_by_grams``.
    """
    known = names.select(name).filter(F.length(name) > 0).distinct()
    total = known.agg(F.sum(F.length(name)).alias("n")).first().n or 0
    if total > most:
        return contained_by_grams(texts, text, known, name)
    words = sorted(r[0] for r in known.collect())  # ``most`` letters at most
    parts, size = [[]], 0
    for w in words:
        if size + len(w) > TABLE_LETTERS and parts[-1]:
            parts.append([])
            size = 0
        parts[-1].append(w)
        size += len(w)

    def seek(batches):
        automata = [Automaton(p) for p in parts]
        for frame in batches:
            rows = frame[text].tolist()
            for a in automata:
                at, which = a.found(rows)
                yield pd.DataFrame({text: [rows[i] for i in at], name: [a.words[k] for k in which]}, dtype=object)

    rows = texts.select(text).filter(F.length(text) > 0).distinct()
    return rows.mapInPandas(seek, f"`{text}` string, `{name}` string")


def contained_by_grams(texts: DataFrame, text: str, names: DataFrame, name: str, gram: int = 8) -> DataFrame:
    """The same by an index of the names' beginnings, for more names than tasks can hold.

    A name is found by its first ``gram`` letters, or by all of it where it is shorter;
    texts give one row per place and length, short lengths only where names have them.
    """
    known = names.select(name).filter(F.length(name) > 0).distinct().withColumn("head", F.substring(name, 1, gram))
    lengths = known.agg(F.array_sort(F.collect_set(F.length("head"))).alias("lengths"))  # one row of ``gram`` numbers at most
    rows = texts.select(text).distinct().crossJoin(F.broadcast(lengths)).select(text, F.explode(F.filter("lengths", lambda k: k <= F.length(text))).alias("k"))
    places = rows.select(text, "k", F.explode(F.sequence(F.lit(1), F.length(text) - F.col("k") + 1)).alias("at"))
    places = places.withColumn("head", F.substring(F.col(text), F.col("at"), F.col("k")))
    hits = places.join(known, "head").filter(F.substring(F.col(text), F.col("at"), F.length(name)) == F.col(name))
    return hits.select(text, name).distinct()


def exact_alias(names: DataFrame, alias: DataFrame) -> DataFrame:
    """Case-insensitive alias lookup; the lowest official of an alias."""
    low = alias.groupBy(F.lower("alias").alias("low")).agg(F.min("official_id").alias("official_id"))
    return names.withColumn("low", F.lower("name")).join(low, "low", "left").drop("low")


def ranked_candidates(names: DataFrame, officials: DataFrame, threshold: float = 0.65, top: int = 5) -> DataFrame:
    """The best officials per name by similarity; ties go to the lower id."""
    pairs = similar_pairs(names, officials, "name", "name", "official_id", "canonical_name", threshold)
    w = Window.partitionBy("ka").orderBy(F.desc("similarity"), "kb")
    return pairs.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= top).select(F.col("ka").alias("name"), F.col("kb").alias("official_id"), "similarity", "rn")


def high_confidence(names: DataFrame, officials: DataFrame, alias: DataFrame) -> DataFrame:
    """Exact alias, else the only candidate at 0.9 or more."""
    exact = exact_alias(names, alias).filter("official_id is not null").select("name", "official_id", F.lit("alias").alias("matched_via"))
    rest = names.join(exact, "name", "left_anti")
    cand = ranked_candidates(rest, officials, 0.9)
    one = cand.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("name"))).filter("n = 1")
    return exact.unionByName(one.select("name", "official_id", F.lit("similar").alias("matched_via")))


def bulk_resolve(names: DataFrame, alias: DataFrame, officials: DataFrame, holders: DataFrame | None = None) -> DataFrame:
    """Staged resolution of distinct names: guard, alias, stripped alias, unique surname with agreeing first name.

    A bare surname can only mean one of ``holders`` (official_id; all officials
    where none are given), and only where one of them alone has it.  The distinct
    names are written first, as every stage reads them.
    """
    base = settled(names.select("name").distinct())
    bad = N.looks_unresolvable(F.col("name"))
    good = base.filter(~bad)
    low = alias.groupBy(F.lower("alias").alias("low")).agg(F.min("official_id").alias("official_id"))
    by = lambda df, expr, via: df.withColumn("low", F.lower(expr)).join(low, "low").select("name", "official_id", F.lit(via).alias("matched_via"))
    one = by(good, F.col("name"), "alias")
    left = good.join(one, "name", "left_anti")
    two = by(left, N.strip_title(F.col("name")), "stripped")
    left = left.join(two, "name", "left_anti")
    parts = left.withColumn("p", N.split_name(N.strip_title(F.col("name")))).withColumn("last", F.lower("p.last"))
    known = officials.withColumn("q", N.split_name(F.col("canonical_name"))).select("official_id", F.lower("q.last").alias("last"), F.col("q.first").alias("o_first"))
    if holders is None:
        known = known.withColumn("holds", F.lit(True))
    else:
        known = known.join(holders.select("official_id", F.lit(True).alias("holds")).distinct(), "official_id", "left")
    near = parts.join(known, "last").filter(F.when(F.col("p.first").isNull(), F.col("holds")).otherwise(N.first_names_agree(F.col("p.first"), F.col("o_first"))))
    only = near.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("official_id").alias("official_id")).filter("n = 1")
    three = only.select("name", "official_id", F.lit("surname").alias("matched_via"))
    done = one.unionByName(two).unionByName(three)
    return base.join(done, "name", "left").withColumn("matched_via", F.coalesce("matched_via", F.when(bad, "unresolvable").otherwise("none")))


def merge_candidates(pairs: DataFrame, votes: DataFrame) -> DataFrame:
    """Which of two similar officials stays: more votes, then the lower id; sure when the ratio is above 50."""
    n = votes.groupBy("official_id").agg(F.count(F.lit(1)).alias("n"))
    rows = pairs.join(n.select(F.col("official_id").alias("ka"), F.col("n").alias("na")), "ka", "left").join(n.select(F.col("official_id").alias("kb"), F.col("n").alias("nb")), "kb", "left").fillna(0, ["na", "nb"])
    first = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ka") < F.col("kb")))
    keep, gone = F.when(first, F.col("ka")).otherwise(F.col("kb")), F.when(first, F.col("kb")).otherwise(F.col("ka"))
    ratio = F.greatest("na", "nb") / F.greatest(F.least("na", "nb"), F.lit(1))
    return rows.select(keep.alias("canonical_id"), gone.alias("duplicate_id"), F.round(ratio, 4).alias("ratio"), "similarity")


def merge_mapping(edges: DataFrame, path: str | None = None) -> DataFrame:
    """node -> smallest node it is chained to; each round halves the chains and is checkpointed."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")).distinct()
    label = both.select(F.col("u").alias("node")).distinct().withColumn("root", F.col("node"))
    while True:
        near = both.join(label.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("root").alias("near"))
        step = label.join(near, label.node == near.u).select("node", F.least("root", "near").alias("root"))
        up = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
        new = step.join(up, "root").select("node", F.least("root", "up").alias("root")).checkpoint()
        if new.join(label.withColumnRenamed("root", "old"), "node").filter("root <> old").isEmpty():
            return new
        label = new


MERGE_SOURCE = "merge_officials_job"


def merged_tables(vote: DataFrame, term: DataFrame, alias: DataFrame, official: DataFrame, mapping: DataFrame) -> dict[str, DataFrame]:
    """votes, terms, aliases and officials after all merges, from one mapping (node, root) of officials.

    Votes and terms move to the root; of two votes on a motion the root's own stays, then
    the lower duplicate's.  Aliases (official_id, alias, source) move unless the root has
    them, and a duplicate's own name stays as an alias, of ``MERGE_SOURCE``.  Duplicates go
    from officials (official_id, canonical_name, ...).
    """
    to = mapping.select(F.col("node").alias("official_id"), "root")
    root = F.coalesce("root", "official_id")
    gone = to.filter("root <> official_id")
    moved = alias.join(to, "official_id", "left").select(root.alias("target"), "alias", "source", (root != F.col("official_id")).cast("int").alias("step"), "official_id")
    named = official.join(gone, "official_id").select(F.col("root").alias("target"), F.col("canonical_name").alias("alias"), F.lit(MERGE_SOURCE).alias("source"), F.lit(2).alias("step"), "official_id")
    first = Window.partitionBy("target", "alias").orderBy("step", "official_id", "source")
    aliases = moved.unionByName(named).withColumn("rn", F.row_number().over(first)).filter("rn = 1").select(F.col("target").alias("official_id"), "alias", "source")
    terms = term.join(to, "official_id", "left").withColumn("official_id", root).select(*term.columns)
    return {"vote": apply_merges(vote, mapping), "term": terms, "alias": aliases, "official": official.join(gone.select("official_id"), "official_id", "left_anti")}


def apply_merges(vote: DataFrame, mapping: DataFrame) -> DataFrame:
    """Votes under their canonical official; of two on one motion the canonical's own stays."""
    rows = vote.join(mapping.withColumnRenamed("node", "official_id"), "official_id", "left").withColumn("target", F.coalesce("root", "official_id"))
    w = Window.partitionBy("target", "motion_id").orderBy((F.col("target") != F.col("official_id")).cast("int"), "official_id")
    return rows.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("motion_id", F.col("target").alias("official_id"), "vote_value")
