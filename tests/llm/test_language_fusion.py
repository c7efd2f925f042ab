"""op10: the posterior against loops over all pages, and hostile pages."""

import math
import random
import time

import pytest

from quorumdf.llm import language_id as L

LANGUAGES = ["de", "en", "fr"]


def softmax(logs):
    top = max(logs)
    e = [math.exp(x - top) for x in logs]
    return [x / sum(e) for x in e]


def brute(rows):
    n = len(LANGUAGES)
    soft = {r[0]: softmax(r[6]) for r in rows}
    total = [sum(s[k] for s in soft.values()) for k in range(n)]
    share = [(x + 1) / (sum(total) + n) for x in total]
    out = {}
    for page, host, domain, suffix, declared, _, evidence in rows:
        own = soft[page]

        def others(at, value):
            return [max(sum(soft[r[0]][k] for r in rows if r[at] == value) - own[k], 0) for k in range(n)]

        def likelihood(at, value):
            return [math.log((x + L.ALPHA) / (max(t - o, 0) + 2 * L.ALPHA)) for x, t, o in zip(others(at, value), total, own)]

        by_domain, by_host = others(2, domain), others(1, host)
        p_domain = [(x + L.KAPPA_DOMAIN * p) / (sum(by_domain) + L.KAPPA_DOMAIN) for x, p in zip(by_domain, share)]
        p_host = share if host == "" else [(x + L.KAPPA_HOST * p) / (sum(by_host) + L.KAPPA_HOST) for x, p in zip(by_host, p_domain)]
        logs = [e + math.log(p) for e, p in zip(evidence, p_host)]
        if suffix:
            logs = [a + b for a, b in zip(logs, likelihood(3, suffix))]
        if declared is not None:
            logs = [a + b for a, b in zip(logs, likelihood(4, declared))]
        posterior = softmax(logs)
        best = max(range(n), key=lambda k: (posterior[k], -k))
        out[page] = (LANGUAGES[best], posterior[best])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_fusion_equals_brute_force(spark, seed):
    rnd, rows = random.Random(seed), []
    for i in range(60):
        host = rnd.choice(["a.x.de", "b.x.de", "y.co.uk", "z.com", ""])
        _, domain, suffix = L.address(f"http://{host}/") if host else ("", "", "")
        evidence = [rnd.gauss(0, 2) for _ in LANGUAGES] if i % 7 else [0.0] * 3
        rows.append((i, host, domain, suffix, rnd.choice([None, "de", "en"]), 9, evidence))
    table = spark.createDataFrame(rows, "page_id long, host string, domain string, suffix string, declared string, n_symbols long, evidence array<double>")
    got, want = {r.page_id: (r.lang, r.confidence) for r in L.fuse(table, LANGUAGES).collect()}, brute(rows)
    assert set(got) == set(want)
    for page, (lang, confidence) in want.items():
        assert got[page][1] == pytest.approx(confidence) and got[page][0] == lang


def test_registered_domains():
    assert L.address("https://www.news.co.uk/a")[1:] == ("news.co.uk", "uk") and L.address("http://a.b.de")[1:] == ("b.de", "de")
    assert L.address("http://co.uk")[1] == "co.uk" and L.address("")[0] == ""


def test_parts_of_pages():
    assert L.page_text("a<nav>b<nav>c</nav>d</nav>e") == "a d e" and L.page_text("x<header>y") == "x y"
    assert L.page_text("<main>in</main>out") == "in" and L.page_text("a<script>b") == "a" and L.page_text("<!-- x -->a<style>b</style>c") == "a c"


@pytest.mark.parametrize("piece", ["<script ", "<nav ", "<nav>", "<", "<!--", "<html ", "<main ", "<style><"])
def test_hostile_pages_take_linear_time(piece):
    began = time.time()
    L.page_text("</nav>" + piece * 100_000)
    L.declared_language(piece * 100_000)
    assert time.time() - began < 5
