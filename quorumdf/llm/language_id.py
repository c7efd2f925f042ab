"""Language identification of web pages by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior per page
  * text: trigram models over the shared symbols, one per language, counted over
    all rows of ``documents``; the log likelihood is tempered, as neighbouring
    symbols are not independent;
  * the language that the markup declares, and the suffix of the address: how
    often a value goes with a language is counted over all pages with their text
    posteriors as weights (a grouped aggregation);
  * the host: a prior smoothed from all pages to the registered domain to the
    host, from the same weights without the page's own.

Only tables by (language, trigram), at most 64 ** 3 per language, reach the
driver; hosts, domains and declarations stay grouped tables that are joined.

Defined results: null and empty pages have no text evidence and follow the rest;
a page with no evidence gets the overall share of languages; ties go to the
language that sorts first; documents without a language are not counted; with no
counted document the table's result has a null language; an empty table gives
none; rows that repeat an id are judged each; pages of any length are read whole;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, whole_text, written
from .symbols import SIZE, codes

ORDER = 3
MIXTURE = (0.6, 0.28, 0.11, 0.01)
TEMPER = 0.75  # exponent of the number of symbols that count as independent
KAPPA_HOST, KAPPA_DOMAIN, ALPHA = 4.0, 8.0, 0.5
PIECE = 4 << 20

#: What isn't closed lasts to the end of the page.
_DROP = re.compile(r"<script\b.*?(?:</script\s*>|\Z)|<style\b.*?(?:</style\s*>|\Z)|<!--.*?(?:-->|\Z)", re.S | re.I)
_MAIN = re.compile(r"<(article|main)\b[^<>]*>(.*?)(?:</\1\s*>|\Z)", re.S | re.I)
_ASIDE = re.compile(r"<(/?)(nav|footer|aside|header)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[^<>]*>")
_DECLARED = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.I)
_META = re.compile(r"<meta\b[^<>]*?content-language[^<>]*?content\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.I)
#: Labels under which a country's names are registered one level deeper.
_SECOND = {"ac", "co", "com", "edu", "gov", "net", "org"}


def _without_asides(html: str) -> str:
    """The page without its navigation, headers and footers, in one pass; what isn't closed stays."""
    out, at, opened = [], 0, None
    closed_last = {}
    tags = list(_ASIDE.finditer(html))
    for m in tags:
        if m.group(1):
            closed_last[m.group(2).lower()] = m.start()
    for m in tags:
        name = m.group(2).lower()
        if opened is None and not m.group(1) and closed_last.get(name, -1) > m.start():
            out.append(html[at : m.start()])
            opened = name
        elif opened == name and m.group(1):
            at, opened = m.end(), None
    return " ".join([*out, html[at:]])


def page_text(html: str) -> str:
    """The text of the main part of a page; of the whole body where none is marked."""
    html = _DROP.sub(" ", html)
    main = [m.group(2) for m in _MAIN.finditer(html)]
    body = " ".join(main) if main else _without_asides(html)
    return re.sub(r"\s+", " ", unescape(_TAG.sub(" ", body))).strip()


def declared_language(html: str) -> str | None:
    m = _DECLARED.search(html) or _META.search(html)
    return m.group(1).lower() if m else None


def address(url: str) -> tuple[str, str, str]:
    """(host, registered domain, suffix); empty strings where the address has none."""
    try:
        host = (urlsplit(url if "//" in url else "//" + url).hostname or "").rstrip(".")
    except ValueError:
        host = ""
    labels = host.split(".") if host else []
    deep = len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in _SECOND
    return host, ".".join(labels[-3:] if deep else labels[-2:]), labels[-1] if len(labels) > 1 else ""


def _count(batches):
    sums: dict[str, np.ndarray] = {}
    for pdf in batches:
        for lang, text in zip(pdf["lang"], pdf["text"]):
            raw = text.encode("utf-8", "surrogatepass")
            mine = sums.setdefault(lang, np.zeros(SIZE**ORDER, np.int64))
            for at in range(0, len(raw), PIECE):
                lead = min(at, ORDER - 1)
                code, n = np.unique(codes(raw[at - lead : at + PIECE], ORDER)[lead:], return_counts=True)
                mine[code] += n
    for lang, dense in sums.items():
        code = np.flatnonzero(dense)
        yield pd.DataFrame({"lang": lang, "code": code, "n": dense[code]})


def interpolated_losses(code: np.ndarray, n: np.ndarray, at: np.ndarray, order: int, mixture: tuple) -> np.ndarray:
    """Loss (nats) of the last symbol of each code in ``at`` under interpolated counts."""
    total = np.full(len(at), mixture[-1] / SIZE)
    for k, weight in zip(range(order, 0, -1), mixture):
        modulus = SIZE**k
        gram = np.bincount(code % modulus, n, minlength=modulus) if k <= 3 else None
        if gram is None:
            spot = np.searchsorted(code, at)
            spot = np.minimum(spot, max(0, len(code) - 1))
            hit = np.where(code[spot] == at, n[spot], 0) if len(code) else np.zeros(len(at))
        else:
            hit = gram[at % modulus]
        history = np.bincount(code // SIZE % (modulus // SIZE), n, minlength=modulus // SIZE) if k > 1 else np.array([n.sum()])
        seen = history[at // SIZE % (modulus // SIZE)] if k > 1 else history[np.zeros(len(at), np.int64)]
        total += weight * np.divide(hit, seen, out=np.full(len(at), 1 / SIZE), where=seen > 0)
    return -np.log(total)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities by trigram and language) from all documents."""
    rows = docs.filter("lang is not null").select("lang", whole_text().alias("text"))
    counts = rows.mapInPandas(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    at = np.arange(SIZE**ORDER)
    columns = [
        -interpolated_losses(g["code"].to_numpy(np.int64), g["n"].to_numpy(np.float64), at, ORDER, MIXTURE)
        for g in (counts[counts["lang"] == name].sort_values("code") for name in languages)
    ]
    return languages, np.stack(columns, 1).astype(np.float32) if columns else np.zeros((SIZE**ORDER, 0), np.float32)


def text_evidence(pages: DataFrame, model: tuple[list[str], np.ndarray], html: bool = True) -> DataFrame:
    """page_id, host, domain, suffix, declared, n_symbols, evidence (tempered log likelihoods)."""
    shared = pages.sparkSession.sparkContext.broadcast(model[1])  # 64 ** 3 rows by the number of languages
    n_lang = len(model[0])
    rows = pages.select("page_id", whole_text("url").alias("url"), whole_text("html" if html else "text").alias("html"))

    def run(batches):
        logp = shared.value
        for pdf in batches:
            out = []
            for url, page in zip(pdf["url"], pdf["html"]):
                raw = (page_text(page) if html else page).encode("utf-8", "surrogatepass")
                sums = np.zeros(n_lang)
                for at in range(0, len(raw), PIECE):
                    lead = min(at, ORDER - 1)
                    sums += logp[codes(raw[at - lead : at + PIECE], ORDER)[lead:]].sum(axis=0, dtype=np.float64)
                n = len(raw)
                out.append((*address(url), declared_language(page) if html else None, n, (sums / n * n**TEMPER if n else sums).tolist()))
            yield pd.DataFrame({"page_id": pdf["page_id"], **{c: [o[k] for o in out] for k, c in enumerate(("host", "domain", "suffix", "declared", "n_symbols", "evidence"))}})

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"page_id {kind}, host string, domain string, suffix string, declared string, n_symbols long, evidence array<double>")


def _softmax(logs):
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, y: s + y))


def _sums(df: DataFrame, keys: list[str], n: int, prefix: str) -> DataFrame:
    """Soft counts of the languages per key, as an array, by a grouped aggregation."""
    added = df.groupBy(*keys).agg(*[F.sum(F.get("soft", F.lit(i))).alias(f"s{i}") for i in range(n)])
    return added.select(*keys, F.array(*[f"s{i}" for i in range(n)]).alias(prefix))


def fuse(evidence: DataFrame, languages: list[str]) -> DataFrame:
    """The posterior of every page from its text, declaration, suffix and host."""
    n = len(languages)
    pages = written(evidence.withColumn("soft", _softmax(F.col("evidence"))), "evidence")
    total = pages.agg(*[F.sum(F.get("soft", F.lit(i))).alias(f"s{i}") for i in range(n)]).first()
    total = [float(x or 0.0) for x in total]
    share = F.array(*[F.lit((x + 1.0) / (sum(total) + n)) for x in total])
    all_soft = F.array(*map(F.lit, total))

    joined = (
        pages.join(_sums(pages, ["host"], n, "by_host"), "host", "left")
        .join(_sums(pages, ["domain"], n, "by_domain"), "domain", "left")
        .join(_sums(pages, ["suffix"], n, "by_suffix"), "suffix", "left")
        .join(_sums(pages.filter("declared is not null"), ["declared"], n, "by_declared"), "declared", "left")
    )

    def minus_own(column):
        return F.zip_with(F.col(column), F.col("soft"), lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def likelihood(column):
        """log P(value | language) by soft counts without the page's own, up to a constant."""
        own = F.zip_with(minus_own(column), F.zip_with(all_soft, F.col("soft"), lambda a, b: F.greatest(a - b, F.lit(0.0))), lambda x, t: F.ln((x + ALPHA) / (t + 2 * ALPHA)))
        return F.coalesce(own, F.array(*[F.lit(0.0)] * n))

    def smoothed(column, prior, kappa):
        mass = F.aggregate(minus_own(column), F.lit(0.0), lambda s, x: s + x)
        return F.zip_with(minus_own(column), prior, lambda x, p: (x + kappa * p) / (mass + kappa))

    joined = joined.withColumn("p_domain", smoothed("by_domain", share, KAPPA_DOMAIN))
    joined = joined.withColumn("p_host", F.when(F.col("host") == "", share).otherwise(smoothed("by_host", F.col("p_domain"), KAPPA_HOST)))
    suffix = F.when(F.col("suffix") == "", F.array(*[F.lit(0.0)] * n)).otherwise(likelihood("by_suffix"))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    logs = add(add(F.col("evidence"), F.transform("p_host", lambda x: F.ln(x))), add(suffix, likelihood("by_declared")))
    joined = joined.withColumn("posterior", _softmax(logs))
    names = F.array(*map(F.lit, languages))
    best = lambda a: F.get(names, F.array_position(F.col(a), F.array_max(a)).cast("int") - 1)
    return joined.select(
        "page_id", "host", "declared", "n_symbols", best("soft").alias("text_lang"), best("posterior").alias("lang"), F.array_max("posterior").alias("confidence")
    )


def identify_pages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, host, declared, n_symbols, text_lang, lang, confidence for every page."""
    model = train(docs)
    if not model[0]:
        nothing = F.lit(None).cast("string")
        return pages.select("page_id", *[nothing.alias(c) for c in ("host", "declared")], F.lit(0).cast("long").alias("n_symbols"), nothing.alias("text_lang"), nothing.alias("lang"), F.lit(0.0).alias("confidence"))
    return fuse(text_evidence(pages, model), model[0])


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    return identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
