"""The queries of the training-data operators, one thin ``opN_<name>`` each.

A query calls its operator on a whole table with production parameters and
derives the columns that are returned.  ``ORACLE_SQL`` has DuckDB SQL where SQL
can express the result; the others are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.llm import decontaminate, exact_dedup, language_id, lexical_search, packing, sentence_dedup, simhash_dedup, spelling, suffix_dedup, token_files, toxicity, url_filter, warc
from statlens.llm.common import LOWER, UPPER, read_table


def page_document():
    """The document that a page shows: the number at the end of its url's path."""
    return F.regexp_extract("url", r"/(\d+)(?:\.html)?/?(?:[?#]|$)", 1).try_cast("long")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: a page is good when its document is labelled of good quality and not toxic."""
    pages = read_table(spark, sf_dir, "pages")
    labels = read_table(spark, sf_dir, "labels").selectExpr("doc_id", "cast(quality = 1 AND toxic = 0 AS int) AS good")
    shown = pages.select("page_id", page_document().alias("shown")).where("shown IS NOT NULL")
    outcomes = shown.join(labels, F.expr("shown = doc_id")).select("page_id", "good")
    return url_filter.judge_urls(spark, pages, outcomes)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    web = language_id.web_evidence(read_table(spark, sf_dir, "pages"), page_document())
    return language_id.identify(spark, read_table(spark, sf_dir, "documents"), web)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark, read_table(spark, sf_dir, "documents"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(spark, read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = warc.archive_and_read(spark, read_table(spark, sf_dir, "pages"))
    return chunks.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(spark, read_table(spark, sf_dir, "documents")).drop("spans")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_dedup.dedup_sentences(spark, read_table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(spark, read_table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.stored_documents(spark, read_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spark, read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_language_id": op2_language_id,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_warc": op5_warc,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_sentence_dedup": op9_sentence_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_token_files": op11_token_files,
    "op12_lexical_search": op12_lexical_search,
    "op13_spelling_variants": op13_spelling_variants,
}


def _level(name: str, rows: str, keys: str, parent: str) -> str:
    """SQL of one level of the host reputation: its prior strength, then its smoothed rates."""
    num = "sum(CASE WHEN n > 0 THEN (s - n * p) * (s - n * p) - n * p * (1 - p) END)"
    den = "sum(CASE WHEN n > 0 THEN n * (n - 1) * p * (1 - p) END)"
    rho = f"CASE WHEN coalesce({den}, 0) = 0 THEN {url_filter.NO_RHO} ELSE least(greatest({num} / {den}, {url_filter.LOW_RHO}), {url_filter.HIGH_RHO}) END"
    return f"""
        {name}_c AS (SELECT {keys}, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(s) AS DOUBLE) AS s, any_value(p) AS p FROM {rows} {parent} GROUP BY {keys}),
        {name}_k AS (SELECT (1 - rho) / rho AS k FROM (SELECT {rho} AS rho FROM {name}_c)),
        {name} AS (SELECT {keys}, n, s, p, k, (s + k * p) / (n + k) AS r FROM {name}_c, {name}_k),"""


def _url_sql() -> str:
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v)
            for h, p, v in sorted(url_filter.RULES, key=lambda r: -len(r[0] + r[1]))]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits) + " END"
    said = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits) + " END"
    return rf"""
    WITH cut AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        urls AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                        TRY_CAST(nullif(regexp_extract(url, '/([0-9]+)(?:\.html)?/?(?:[?#]|$)', 1), '') AS BIGINT) AS shown FROM cut),
        good AS (SELECT page_id, max(CAST(quality = 1 AND toxic = 0 AS INT)) AS good FROM urls JOIN labels ON shown = doc_id GROUP BY page_id),
        hosts AS (SELECT host, regexp_extract(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '([^.]+)$', 1) AS suffix,
                         regexp_extract(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '([^.]+(?:\.[^.]+)?)$', 1) AS domain,
                         count(good) AS n, coalesce(sum(good), 0) AS s FROM urls LEFT JOIN good USING (page_id) GROUP BY host),
        overall AS (SELECT (sum(s) + 1) / (sum(n) + 2) AS p FROM hosts),
        {_level("sx", "hosts", "suffix", ", overall").strip()}
        {_level("dx", "hosts h JOIN (SELECT suffix AS x, r AS p FROM sx) q ON h.suffix = q.x", "domain", "").strip()}
        {_level("hx", "hosts h JOIN (SELECT domain AS x, r AS p FROM dx) q ON h.domain = q.x", "host", "").strip()}
        post AS (SELECT host, s + k * p AS a, n - s + k * (1 - p) AS b FROM hx),
        known AS (SELECT host, a / (a + b) - {url_filter.Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM post)
    SELECT page_id, host, path, {rule} AS rule, coalesce({said}, CASE WHEN bound >= {url_filter.LEAST} THEN 'allow' ELSE 'block' END) AS verdict,
           round(bound, 4) AS bound
    FROM urls JOIN known USING (host)"""


TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLE_SQL = {
    "op12_lexical_search": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERMS}') AS terms FROM documents),
            sizes AS (SELECT r, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
            corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
            tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY r, term),
            wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERMS}')) AS term FROM benchmark),
            weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
                        FROM tf, corpus WHERE term IN (SELECT term FROM wanted) GROUP BY term),
            scores AS (SELECT item_id, doc_id, r,
                              CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
                       FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (r), corpus GROUP BY item_id, doc_id, r)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
        FROM scores WHERE score > 0 QUALIFY rank <= 10
    """,
    "op1_url_filter": _url_sql(),
    "op3_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
        WINDOW w AS (PARTITION BY t)
    """,
}
