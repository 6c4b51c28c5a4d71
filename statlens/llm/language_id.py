"""Language ID by Bayesian evidence fusion.

A document's posterior over languages is the product of
* a text likelihood: byte trigrams (A-Z folded) under a smoothed table for each
  language, tempered so that ``EFFECTIVE`` trigrams count at most;
* the declared markup language, right with probability ``DECLARED``;
* the address suffix, by its share in each language (grouped aggregation);
* a host prior, smoothed towards the registered domain's, the suffix's and the
  overall shares (grouped aggregation of the text posteriors).
Pages that show one document repeat each other rather than add evidence, so what
they declare and where they are is pooled: the logarithms are averaged over the
document's pages (over those that declare a known language, for the markup), and
a document counts once, in parts, for the hosts of its pages.

Besides the languages there is ``und``, under which all trigrams are equally
likely.  Documents whose best language is ``und``, or less than even, are
rejected; so are documents without a letter.

The tables are fitted on about ``SAMPLE`` labelled documents of each language, on
all where a language has no more; host and suffix counts cover all documents.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.llm.common import bounded_batches, drop_rows, row_key, staged, text_key
from statlens.llm.textvec import FOLD, IS_WORD, slices

SAMPLE, BUCKETS, SMOOTHING, EFFECTIVE = 8000, 1 << 16, 0.05, 100
DECLARED, STRENGTH, UND_PRIOR, LEAST_POSTERIOR = 0.9, 20.0, 1e-3, 0.5
#: Bytes of text whose trigrams are taken at once; a longer text is taken in parts.
TEXT_BLOCK = 1 << 19


def trigrams(texts: list[bytes], inner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text) of every byte trigram around a letter, without digits, and whether each text has a letter.

    ``inner``: where texts are parts of longer ones, whether each part's first and
    last byte (two columns) only stand beside it; no trigram is taken around these.
    """
    joined = FOLD[np.frombuffer(b"\n" + b"\n\n".join(texts) + b"\n\n", np.uint8)]
    ends = np.cumsum([len(t) + 2 for t in texts])
    digit = (joined >= 48) & (joined <= 57)
    word = IS_WORD[joined] & ~digit  # numbers, keys and addresses tell no language
    x = joined.astype(np.uint32)
    code = (x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA6B)) ^ (x[2:] * np.uint32(0xC2B2AE35))
    around = word[1:-1] & (word[:-2] | word[2:]) & ~digit[:-2] & ~digit[2:]
    if inner is not None:
        around[np.r_[0, ends[:-1]][inner[:, 0]]] = False  # ``around`` starts with the first text's first byte
        around[ends[inner[:, 1]] - 3] = False
    use = np.flatnonzero(around)
    bucket = ((code[use] * np.uint32(0x27D4EB2F)) >> np.uint32(16)).astype(np.int64)
    at = np.searchsorted(ends, use, side="right")
    letters = np.bincount(np.searchsorted(ends, np.flatnonzero(word) - 1, side="right"), minlength=len(texts)) > 0
    return bucket, at, letters


def trigram_blocks(texts: list[bytes], limit: int = TEXT_BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket, text, letters) as from ``trigrams``, for at most ``limit`` bytes at a time; ``letters`` are the numbers of texts with one."""
    parts = [(i, a) for i, t in enumerate(texts) for a in range(0, max(len(t), 1), limit)]
    for cut in slices([min(len(texts[i]) - a, limit) for i, a in parts], limit):
        own = parts[cut]
        inner = np.array([(a > 0, a + limit < len(texts[i])) for i, a in own])
        pieces = [texts[i][max(a - 1, 0):a + limit + 1] for i, a in own]
        bucket, at, letters = trigrams(pieces, inner)
        number = np.array([i for i, _ in own])
        yield bucket, number[at], number[letters]


def encoded(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def trigram_counts(labelled: DataFrame) -> DataFrame:
    """``lang, bucket, n`` of ``labelled`` (``t``, ``lang``), summed in each task before the shuffle."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, g in b.groupby("lang"):
                n = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for bucket, _, _ in trigram_blocks(encoded(g["t"])):
                    n += np.bincount(bucket, minlength=BUCKETS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})

    return labelled.mapInPandas(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each bucket by language), from about ``sample`` labelled rows a language.

    A row is taken if the hash of its id and text is below its language's share,
    ``sample`` of all rows; a language of at most ``sample`` rows is taken whole.
    """
    labelled = docs.where("lang IS NOT NULL AND lang <> 'und' AND length(text) > 0")
    sizes = labelled.groupBy("lang").count().withColumnsRenamed({"lang": "l_", "count": "n_"})
    sizes = staged(spark, sizes, "languages")
    place = f"shiftrightunsigned(xxhash64(doc_id, text), 11) / {float(1 << 53)!r}D"  # from 0 to 1
    rows = labelled.join(sizes, F.expr("lang = l_")).where(f"{place} < {sample} / n_")
    counts = trigram_counts(rows.select(F.col("text").alias("t"), "lang")).toPandas()  # at most BUCKETS rows a language
    langs = sorted(counts["lang"].unique())
    table = np.full((len(langs), BUCKETS), SMOOTHING)
    for i, lang in enumerate(langs):
        own = counts[counts["lang"] == lang]
        table[i, own["bucket"].to_numpy()] += own["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def text_scores(spark: SparkSession, docs: DataFrame, table: np.ndarray) -> DataFrame:
    """``given, d, t1, t2`` (see ``row_key``)``, ll, letters``: tempered log likelihoods by language and, last, under ``und``."""
    model = spark.sparkContext.broadcast(np.vstack([table, np.full(BUCKETS, -np.log(BUCKETS))]).astype(np.float32))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, letters = np.zeros(len(b), np.int64), np.zeros(len(b), bool)
            ll = np.zeros((len(b), len(model.value)))
            for bucket, at, lettered in trigram_blocks(encoded(b["t"])):
                first = int(at[0]) if len(at) else 0
                own = slice(first, int(at[-1]) + 1 if len(at) else first)
                n[own] += np.bincount(at - first, minlength=own.stop - first)
                letters[lettered] = True
                for k, row in enumerate(model.value):
                    ll[own, k] += np.bincount(at - first, row[bucket], minlength=own.stop - first)
            ll *= (np.minimum(n, EFFECTIVE) / np.maximum(n, 1))[:, None]
            yield b[["given", "d", "t1", "t2"]].assign(ll=list(ll), letters=letters)

    rows = docs.select(*row_key(), F.coalesce("text", F.lit("")).alias("t"))
    return rows.mapInPandas(run, "given boolean, d long, t1 long, t2 long, ll array<double>, letters boolean")


def softmax(log: str) -> str:
    """SQL of the probabilities of an array of log weights."""
    up = f"transform({log}, x -> exp(x - array_max({log})))"
    return f"transform({up}, x -> x / aggregate({up}, 0D, (a, y) -> a + y))"


def identify(spark: SparkSession, docs: DataFrame, web: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, lang, posterior, kept`` of every row of ``docs`` (``doc_id, text, lang, source``).

    ``web`` has a row for each page that shows a document: ``doc_id``, ``declared``,
    ``suffix``, ``domain``, ``host`` (any may be null; rows without an id take no
    part).  Without a host the source stands for it; a null is a value like any
    other.  Null and empty texts have no letter: lang ``und``, rejected.  Rows
    that repeat an id are judged one by one; rows without an id too, by their text
    and source.  Without a labelled row there is no language, and all are ``und``.
    An empty table gives an empty result; other columns are not read.
    """
    return judged(spark, docs, web, sample).select("doc_id", "lang", "posterior", "kept")


def judged(spark: SparkSession, docs: DataFrame, web: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """What ``identify`` returns, and the key ``t1, t2`` of each row's text."""
    bounded_batches(spark)
    langs, table = fit(spark, docs, sample)
    n, names = len(langs), ", ".join(f"'{x}'" for x in [*langs, "und"])
    scores = staged(spark, text_scores(spark, docs, table), "scores")
    scores = scores.withColumns({"o1": F.expr("if(given, 0L, t1)"), "o2": F.expr("if(given, 0L, t2)")})  # without an id a text stands for itself
    pages, said = pooled(web, langs)
    about = docs.select(*row_key(), "source").selectExpr("given AS g_", "d AS d_", "if(given, 0L, t1) AS o1_", "if(given, 0L, t2) AS o2_", "source")
    about = about.groupBy("g_", "d_", "o1_", "o2_").agg(F.min("source").alias("source"))
    places = about.join(pages, F.expr("g_ AND d_ = w_"), "left").selectExpr(
        "g_", "d_", "o1_", "o2_", "coalesce(suffix, '-') AS suffix", "coalesce(domain, '-') AS domain",
        "coalesce(host, concat('-', source), '-') AS host", "coalesce(weight, 1D) AS weight")
    places = staged(spark, places, "places")
    key = "given = g_ AND d = d_ AND o1 = o1_ AND o2 = o2_"
    prior = f"transform(ll, (x, i) -> x + if(i = {n}, ln({UND_PRIOR}D), ln({(1 - UND_PRIOR) / max(n, 1)}D)))"
    posts = scores.withColumn("post", F.expr(softmax(prior))).groupBy("given", "d", "o1", "o2").agg(
        *(F.sum(F.expr(f"post[{i}]")).alias(f"p{i}") for i in range(n + 1)))
    again = [F.sum(f"n{i}").alias(f"n{i}") for i in range(n + 1)]
    hosts = staged(spark, posts.join(places, F.expr(key)).groupBy("suffix", "domain", "host").agg(
        *(F.sum(F.expr(f"p{i} * weight")).alias(f"n{i}") for i in range(n + 1))), "hosts")
    flat = "array(" + ", ".join(f"n{i}" for i in range(n + 1)) + ")"
    domains = hosts.groupBy("suffix", "domain").agg(*again).selectExpr("suffix", "domain AS d1", f"{flat} AS c2")
    suffixes = hosts.groupBy("suffix").agg(*again).selectExpr("suffix AS s1", f"{flat} AS c1")
    overall = hosts.agg(*again).first()
    share = np.array([x or 0.0 for x in overall]) + 1.0 / (n + 1)
    whole = "array(" + ", ".join(f"{x!r}D" for x in (share / share.sum()).tolist()) + ")"

    def smooth(counts: str, parent: str) -> str:
        total = f"aggregate({counts}, {STRENGTH}D, (a, x) -> a + x)"
        return f"transform({counts}, (x, i) -> (x + {STRENGTH}D * {parent}[i]) / {total})"

    # share of each language on the suffix against its overall share: the suffix's evidence
    levels = hosts.withColumn("c3", F.expr(flat)).join(
        domains.withColumnRenamed("suffix", "s2"), F.expr("suffix = s2 AND domain = d1")).join(suffixes, F.expr("suffix = s1"))
    levels = levels.withColumn("p1", F.expr(smooth("c1", whole))).withColumn("p2", F.expr(smooth("c2", "p1")))
    levels = levels.withColumn("p3", F.expr(smooth("c3", "p2"))).selectExpr(
        "suffix AS sx", "domain AS dx", "host AS hx", f"transform(p3, (x, i) -> ln(x) + 0.5D * ln(p1[i] / {whole}[i])) AS web")
    levels = staged(spark, levels, "priors")
    web_by = places.join(levels, F.expr("suffix = sx AND domain = dx AND host = hx")).groupBy("g_", "d_", "o1_", "o2_").agg(
        F.array(*(F.sum(F.expr(f"weight * web[{i}]")) for i in range(n + 1))).alias("web"))
    fused = scores.join(web_by, F.expr(key)).drop("g_", "d_", "o1_", "o2_").join(said, F.expr("given AND d = w_"), "left")
    fused = fused.withColumn("log", F.expr("transform(ll, (x, i) -> x + web[i] + coalesce(said[i], 0D))"))
    fused = fused.withColumn("p", F.expr(softmax("log"))).withColumn("best", F.expr("array_max(p)"))
    fused = fused.withColumn("lang", F.expr(f"if(letters, array({names})[cast(array_position(p, best) AS int) - 1], 'und')"))
    return fused.select(F.expr("if(given, d, NULL)").alias("doc_id"), "t1", "t2", "lang", F.expr("if(letters, best, 1D)").alias("posterior"),
                        F.expr(f"lang <> 'und' AND best >= {LEAST_POSTERIOR}D").alias("kept"))


def pooled(web: DataFrame, langs: list[str]) -> tuple[DataFrame, DataFrame]:
    """``w_, suffix, domain, host, weight`` (its share of a document's pages), and ``w_, said`` (pooled log evidence of the declarations)."""
    n = len(langs)
    web = web.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("w_"), F.lower("declared").alias("declared"), "suffix", "domain", "host")
    at = web.groupBy("w_", "suffix", "domain", "host").count()
    all_ = web.groupBy("w_").count().withColumnsRenamed({"w_": "a_", "count": "all"})
    pages = at.join(all_, F.expr("w_ = a_")).selectExpr("w_", "suffix", "domain", "host", "count / all AS weight")
    known = web.where(F.col("declared").isin(langs)) if langs else web.where("false")
    counts = known.groupBy("w_").agg(F.count(F.lit(1)).alias("of"), *(F.count_if(F.col("declared") == x).alias(f"c{i}") for i, x in enumerate(langs)))
    right, wrong = f"ln({DECLARED}D)", f"ln({(1 - DECLARED) / max(n, 1)}D)"
    each = [f"(c{i} * {right} + (of - c{i}) * {wrong}) / of" for i in range(n)] + [wrong]
    return pages, counts.selectExpr("w_", f"array({', '.join(each)}) AS said")


def web_evidence(pages: DataFrame, doc_id: Column) -> DataFrame:
    """What ``pages`` (``url``, ``html``) say about their documents: a row for each page of a document."""
    host = F.regexp_extract(F.lower("url"), r"://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    rows = pages.select(
        doc_id.alias("doc_id"), F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html\b[^<>]*\blang=[\"']?([a-z]{2,3})", 1)), F.lit("")).alias("declared"),
        F.nullif(host, F.lit("")).alias("host"))
    return rows.where("doc_id IS NOT NULL").select("doc_id", "declared", "host", F.regexp_extract("host", r"([^.]+)$", 1).alias("suffix"),
                                                   F.regexp_extract("host", r"([^.]+(?:\.[^.]+)?)$", 1).alias("domain"))


def drop_unidentified(spark: SparkSession, docs: DataFrame, web: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that ``identify`` rejects."""
    gone = staged(spark, judged(spark, docs, web).where("NOT kept").select("doc_id", "t1", "t2"), "rejected")
    return drop_rows(docs, gone, text_key())
