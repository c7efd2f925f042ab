"""The pipeline's rows, all of them, against brute force."""

import hashlib
import math
import random
import re
import struct

import pytest

from quorumdf.llm import quality_cnn


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def copies(doc_id, rate):
    parts, total = max(1, math.ceil(rate / 32)), 0
    for j in range(parts):
        u = int(hashlib.md5(f"mix-1:{doc_id}:{j}".encode()).hexdigest()[:13], 16) / 2**52
        k, p = 0, math.exp(-rate / parts)
        c = p
        while c <= u:
            k += 1
            p *= rate / parts / k
            c += p
        total += k
    return total


def brute(rows, labels, spark):
    import corpus_pipeline

    # the network is trained, so its weights come from fit(); each text is scored alone
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = quality_cnn.fit(docs, labels)
    good = [r for r in rows if model.score([(r[1] or "").encode()])[0] >= quality_cnn.THRESHOLD]
    first = {}
    for i, t, s in sorted(good, key=lambda r: r[0]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), (i, t, s))
    once = list(first.values())
    top = {i: i for i, _, _ in once}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    sets = [(i, shingles(t or "")) for i, t, _ in once]
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                ra, rb = find(a), find(b)
                top[max(ra, rb)] = min(ra, rb)
    left = [r for r in once if find(r[0]) == r[0]]
    sizes = {}
    for _, _, s in left:
        sizes[s] = sizes.get(s, 0) + 1
    total = sum(map(math.sqrt, sizes.values()))
    assert corpus_pipeline.ORACLE_SQL is None
    return {i: copies(i, len(left) * math.sqrt(sizes[s]) / total / sizes[s]) for i, _, s in left}


def test_pipeline_equals_brute_force(spark, tmp_path):
    import corpus_pipeline

    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rnd, rows = random.Random(8), []
    for i in range(160):
        words = ["".join(rnd.choice("aeiourstln") for _ in range(rnd.randint(2, 8))) for _ in range(50)]
        rows.append((i, " ".join(w + "***" for w in words) if i % 4 == 0 else " ".join(words), f"s{min(2, i % 7)}"))
    rows += [(200 + i, rows[i + 1][1].replace(" ", "  "), "s0") for i in range(20)]  # exact copies, other spacing
    rows += [(300 + i, rows[i + 1][1] + " end", "s1") for i in range(20)]  # near copies
    rows += [(400, None, "s0"), (401, "", "s0")]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(160)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, t, "en", s, 1, 0.5, "mine") for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, score double, rate string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got, want, text = {}, brute(rows, labels, spark), {i: t or "" for i, t, _ in rows}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    assert got == {i: n for i, n in want.items() if n} and len(got) > 60
    kept = corpus_pipeline.mixing_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and {(r.score, r.rate) for r in kept.collect()} == {(0.5, "mine")}


def test_empty_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
