"""The corpus operators against brute force on small fixtures."""

import hashlib
import itertools
import math
import random
import re
import struct
import zlib

import pytest

from quorumdf.llm import bpe, exact_dedup, language_id, licenses, mixing, ngram_join, pii, quality_cnn, syncmers

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "   \n\t ", "en", "a", 6),
    (4, "One  two\tthree four five six seven", "en", "b", 34),
    (5, "One two three four five six seven", None, "b", 33),
    (5, "One two three four five six seven", None, "b", 33),
    (6, "x" * 5000, "de", None, 5000),
    (None, "no id here", "en", "a", 10),
    (7, "Été à l'école — naïve 日本 <|endoftext|> end", "fr", "a", 42),
]


def docs(spark, rows=ODD):
    return spark.createDataFrame(rows, DOCS)


def spaced(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup_odd_rows(spark):
    got = sorted((r.doc_id is None, r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(docs(spark)).collect())
    groups = {}
    for i, t, *_ in ODD:
        groups.setdefault(spaced(t), []).append(i)
    want = []
    for i, t, *_ in ODD:
        ids = groups[spaced(t)]
        known = [x for x in ids if x is not None]
        keep = min(known) if known else None
        want.append((i is None, i, keep, len(ids), i == keep, hashlib.sha256(spaced(t).encode()).hexdigest()))
    assert got == sorted(want)


def test_keep_first_keeps_one_row_of_each_text(spark):
    kept = exact_dedup.keep_first(docs(spark))
    assert kept.columns == docs(spark).columns
    assert sorted(spaced(r.text) for r in kept.collect()) == sorted({spaced(t) for _, t, *_ in ODD})


def test_exact_dedup_empty_table_and_extra_columns(spark):
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0
    clash = docs(spark).selectExpr("*", "1 as keep_id", "2 as norm", "3 as salt", "4 as text_sha256")
    assert exact_dedup.exact_dedup(clash).count() == len(ODD)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        both = len(x & y)
        if x and y and 100 * both >= 75 * (len(x) + len(y) - both):
            ra, rb = find(a), find(b)
            top[max(ra, rb)] = min(ra, rb)
    return {(i, len(sets[i]), find(i)) for i in sets}


def near_rows(seed, n=260):
    rnd, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(60)]
    while len(rows) < n:
        words = [rnd.choice("abcdefgh") + str(rnd.randint(0, 40)) for _ in range(rnd.choice([1, 2, 4, 5, 6, 8, 9, 12, 25, 60, 150]))]
        if rnd.random() < 0.3:
            words += passage
        for _ in range(rnd.choice([1, 1, 2, 12])):
            v = list(words)
            for _ in range(rnd.randint(0, max(1, len(v) // 14))):
                v[rnd.randrange(len(v))] = rnd.choice(["zz", "YY"])
            rows.append((len(rows), " \n".join(v[: rnd.randint(max(1, len(v) * 3 // 4), len(v))])))
    return rows + [(n + 50, None), (n + 51, ""), (n + 52, " \t")]


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_equals_brute_force(spark, seed):
    rows = near_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {tuple(r) for r in ngram_join.ngram_jaccard_join(df).collect()}
    assert got == brute_components(rows)


def test_ngram_join_mixed_bucket_blocks(spark, monkeypatch):
    """Buckets split into several blocks give the same links."""
    rows = near_rows(5, 120)
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in ngram_join.ngram_jaccard_join(df).collect()} == brute_components(rows)


def test_ngram_allocation_meets_the_pigeonhole():
    edges = ngram_join.band_edges()
    for band in range(18):
        whole, deleted = ngram_join.allocation(band)
        assert whole + 2 * deleted >= 2 * (int(edges[band + 1]) - 1) // 7 + 1


def test_ngram_join_empty_and_repeated_ids(spark):
    assert ngram_join.ngram_jaccard_join(docs(spark, [])).count() == 0
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(docs(spark)).collect())
    assert [g for g in got if g[0] in (4, 5)] == [(4, 3, 4), (5, 3, 4), (5, 3, 4)]
    kept = ngram_join.keep_one_of_each(docs(spark))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7]


def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return P.path("byte_bpe_50k.json"), Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_bpe_equals_the_library(spark):
    path, library = tokenizer()
    rnd = random.Random(3)
    texts = [t or "" for _, t, *_ in ODD] + ["".join(rnd.choice("ab eth.'0é日 \n") for _ in range(80)) for _ in range(200)] + ["=" * 300, "aaaaaaaaaaa", "  x", "%%%%%"]
    rows = [(i, t, "", "", 0) for i, t in enumerate(texts)]
    for r in bpe.encode_documents(docs(spark, rows), path).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert list(struct.unpack(f"<{r.n_tokens}I", bytes(r.ids))) == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_bpe_small_automaton():
    vocab = {b"a": 0, b"b": 1, b"c": 2, b"ab": 3, b"bc": 4, b"aa": 5, b"abc": 6}
    machine = bpe.MergeAutomaton(vocab, [(b"a", b"b"), (b"b", b"c"), (b"a", b"a"), (b"a", b"bc")])
    assert machine.encode_word(b"abc") == [3, 2]  # ab merges first, so abc is never reached
    assert machine.encode_word(b"aaab") == [5, 3]
    assert not machine.has_arc(0, 1) and machine.has_arc(3, 2)


def test_bpe_odd_rows(spark):
    assert bpe.token_digests(docs(spark, [])).count() == 0
    got = {r.doc_id: r for r in bpe.token_digests(docs(spark)).collect()}
    assert got[1].n_tokens == got[2].n_tokens == 0 and got[1].ids_sha256 == hashlib.sha256(b"").hexdigest()


def brute_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    found = []
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), len(found), min(found, default=[None])[0], max((f[0] for f in found), default=None), ",".join(sorted({f[1] for f in found}))


def test_licenses_base_equals_brute_force(spark):
    texts = [None, "", "Under the MIT License; under the mit-license. under the mit licenses", "été under the MIT license", "Apache License, Version 2.0! CC BY-NC 4.0 cc by nc", "undér the mit license apache license version 2", "GPLv3 or later " * 50]
    rows = [(i, t, "", "", 0) for i, t in enumerate(texts)]
    for r in licenses.scan_licenses(docs(spark, rows)).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_licenses(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert licenses.scan_licenses(docs(spark, [])).count() == 0


def test_licenses_suppression_keeps_the_stronger():
    assert licenses.scan("GNU Lesser General Public License version 2.1, February 1999")["labels"] == "lgpl-2.1"
    found = [(0, 10, 1, 5, "weak", 0.5), (0, 20, 4, 6, "strong", 0.9), (15, 30, 2, 7, "beside", 0.7)]
    assert {d[4] for d in licenses.suppress(found)} == {"strong", "beside"}


@pytest.mark.parametrize("n", [1, 2, 10, 97, 1000, 898 * 99 * 9999])
def test_feistel_is_a_permutation(n):
    p = pii.Permutation(b"k")
    values = range(n) if n <= 1000 else range(0, n, n // 500)
    out = [p.apply(v, n, "t") for v in values]
    assert len(set(out)) == len(out) and all(0 <= v < n for v in out)
    assert [p.apply(v, n, "t", back=True) for v in out] == list(values)


def test_pii_round_trip_and_links(spark):
    values = ["4111 1111 1111 1111", "4111-1111-1111-1111", "GB82 WEST 1234 5698 7654 32", "123-45-6789", "+1 (017) 555-7713", "2024-02-29", "13/12/1999", "12/31/1999", "3/4/2001", 'token = "b44e15e09fd311c3"', "nd.34@mail7.example.com", "97.51.17.173"]
    text = "Début " + " et ".join(values) + " 4111 1111 1111 1112 31/31/2000 999-00-1234 fin"
    perm = pii.Permutation(b"key")
    hidden, spans = pii.pseudonymise(text, perm)
    assert len(spans) == len(values)
    assert all(v.split('"')[-2 if '"' in v else -1] not in hidden for v in values)
    assert "4111 1111 1111 1112 31/31/2000 999-00-1234" in hidden
    assert pii.pseudonymise(hidden, perm, back=True)[0] == text
    first, second = [re.sub(r"\D", "", hidden[a:b]) for a, b, k in pii.find(hidden) if k == "card"]
    assert first == second
    got = {r.doc_id: r for r in pii.pseudonymise_documents(docs(spark), b"key").collect()}
    assert got[1].text is None and got[1].n_private == 0 and got[2].text == ""
    assert pii.pseudonymise_documents(docs(spark, []), b"key").count() == 0


def test_mixing_counts(spark):
    rows = [(i, f"t{i}", "en", "big" if i % 3 else "small", 2) for i in range(300)] + [(900, None, None, None, None), (None, "n", "en", "big", 1)]
    got = mixing.replicate(docs(spark, rows)).collect()
    rates = {r["__source"]: r.rate for r in mixing.source_rates(docs(spark, rows)).collect()}
    n = {"big": 201, "small": 100, "": 1}
    total = sum(math.sqrt(x) for x in n.values())
    copies = {}
    for r in got:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    for s, x in n.items():
        assert abs(rates[s] - 302 * math.sqrt(x) / total / x) < 1e-9
    for i, _, _, s, _ in rows:
        rate = rates[s or ""]
        parts = max(1, math.ceil(rate / 32))
        want = 0
        for j in range(parts):
            u = int(hashlib.md5(f"mix-1:{'null' if i is None else i}:{j}".encode()).hexdigest()[:13], 16) / 2**52
            k, p = 0, math.exp(-rate / parts)
            c = p
            while c <= u:
                k += 1
                p *= rate / parts / k
                c += p
            want += k
        assert copies.get(i, 0) == want
    assert mixing.replicate(docs(spark, [])).count() == 0
    assert {r.source for r in mixing.replicate(docs(spark, rows), {"small": 1.0}).collect()} == {"small"}


def test_fingerprints_and_neighbours(spark):
    rnd = random.Random(4)
    texts = [t or "" for i, t, *_ in ODD if i is not None] + [" ".join(rnd.choice("abcdefghij") + str(rnd.randint(0, 99)) for _ in range(rnd.choice([3, 45, 300]))) for _ in range(60)]
    rows = [(i * 7, t, "", "", 0) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in syncmers.edited_neighbours(docs(spark, rows).repartition(3)).collect()}
    order = sorted(rows, reverse=True)
    for k, (i, t, *_) in enumerate(order):
        other, third = order[(k + 1) % len(order)][1], len(t) // 3
        edited = t[: len(t) - third] + other[:third]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(t)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    by_text = {}
    for i, t, *_ in rows:
        assert by_text.setdefault(t, got[i].fingerprint) == got[i].fingerprint
    long = [i for i, t, *_ in rows if len(t.split()) >= 300]
    assert all(got[i].near_edited > 0.25 > got[i].near_next for i in long)
    assert syncmers.edited_neighbours(docs(spark, [])).count() == 0
    assert syncmers.edited_neighbours(docs(spark)).count() == len(ODD)
    plan = syncmers.fingerprints(docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_quality_network_held_out(spark, tmp_path):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(260):
        words = ["".join(rnd.choice("aeiourstln") for _ in range(rnd.randint(2, 8))) for _ in range(60)]
        bad = i % 2
        rows.append((i, " ".join(w + "***" for w in words) if bad else " ".join(words) + ".", "en", "a", 1))
        labels.append((i, 1 - bad, 0))
    labels += [(9999, None, None)]
    df = docs(spark, rows + [(500, None, None, None, None), (501, "", "", "", 0)])
    got = {r.doc_id: r for r in quality_cnn.predict_quality(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    held = [i for i, *_ in rows if got[i].held_out]
    assert sum(got[i].predicted == 1 - i % 2 for i in held) >= 0.95 * len(held)
    assert got[500].score == got[501].score and 0 <= got[500].score <= 1
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_cnn.predict_quality(df, none).collect()} == {0.5}


def test_quality_chunks_do_not_change_the_score(monkeypatch):
    net = quality_cnn.Network()
    text = bytes(random.Random(1).randrange(97, 123) for _ in range(4000))
    whole = net.score([text])[0]
    assert net.score([b"", text])[1] == pytest.approx(whole)


def test_language_fusion(spark):
    train = docs(spark, [(1, "the house and the tree of this town " * 20, "en", "a", 1), (2, "das Haus und der Baum der Stadt ist " * 20, "de", "a", 1), (3, None, None, None, None)])
    pages = [
        (1, "http://a.b.de/x", "<html lang=de><body><p>der Baum und das Haus</p></body></html>"),
        (2, "http://a.b.de/y", None),
        (3, None, "<html><body>the tree and the town</body></html>"),
        (4, "http://c.com/", "<html lang='en'><nav>das der und Haus</nav><article>the house of this tree</article></html>"),
        (5, "not a url", ""),
    ]
    got = {r.page_id: r for r in language_id.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), train).collect()}
    assert [got[i].lang for i in (1, 2, 3, 4)] == ["de", "de", "en", "en"]
    assert all(0 <= r.confidence <= 1 for r in got.values())
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert language_id.identify_pages(empty, train).count() == 0
    assert language_id.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), docs(spark, [])).count() == 5


