"""Ranked lexical search against every document's exact score, and its bounds."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from statlens.llm import lexical_search, queries
from tests.conftest import SF01
from tests.llm.test_operators import docs, prose, texts  # noqa: F401

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, k=10):
    """[(item_id, rank, doc_id, score)] from every document's score for every item."""
    own = [(i, Counter(terms(t))) for i, t in rows]
    own = [(i, c) for i, c in own if c]
    n_docs, n_terms = len(own), sum(c.total() for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if i is not None and terms(t)}:
        found = []
        for i, c in own:
            m = 10 + (90 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def search(spark, docs, items, **how):  # noqa: F811
    df = spark.createDataFrame([(*x, "clash", 7) for x in items], "item_id long, text string, score string, rank int")
    return sorted((tuple(r) for r in lexical_search.search(spark, docs, df, **how).select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def items(texts):  # noqa: F811
    rng = random.Random(8)
    known = [t for _, t in texts if t and len(t) > 60]
    rows = [(i, " ".join(rng.choice(known).split()[2:2 + rng.choice([1, 4, 20])])) for i in range(12)]
    return rows + [(50, None), (51, ""), (52, "!!! ..."), (53, "nowhere qqqq"), (None, known[0]), (3, "Äé ßü"), (0, rows[0][1]), (54, "Äé x,x X"),
                   (55, "a b c"), (56, known[1])]


def test_search_against_brute_force(spark, docs, texts, items):  # noqa: F811
    assert search(spark, docs, items) == brute(texts, items)


def test_few_seeds_blocks_and_other_k(spark, docs, texts, items):  # noqa: F811
    assert search(spark, docs, items, seeds=3, k=3) == brute(texts, items, 3)
    assert search(spark, docs, items, seeds=1, block=200) == brute(texts, items)


def test_bounds_hold_and_skip_most(spark):
    rng = random.Random(4)
    corpus = [prose(rng, rng.choice([5, 60, 2000])) for _ in range(200)] + ["x " * 400]
    counts = [lexical_search.term_counts(t) for t in corpus]
    n_terms = sum(c.total() for c in counts)
    stated = [dict.fromkeys(list(lexical_search.term_counts(corpus[i]))[:30], 9000 + i) for i in range(20)] + [{b"x": 5000}]
    block = lexical_search.Items(stated, len(corpus), n_terms)
    n = np.array([c.total() for c in counts])
    bounds = block.bounds(n, [lexical_search.sketch(c) for c in counts])
    exact = np.array([[block.score(q, c, lexical_search.length_factor(int(k), len(corpus), n_terms)) for q in range(len(stated))] for c, k in zip(counts, n)])
    assert (bounds >= exact).all()
    assert np.mean(bounds - exact > 0.2 * np.array([bounds[q].max() for q in range(20)] + [bounds[-1].max()])) < 0.05


def test_one_document_takes_a_third(spark, items):
    rows = [(i, "hot words of one text, said often") for i in range(60)] + [(100 + i, prose(random.Random(i), 40)) for i in range(100)]
    df = spark.createDataFrame(rows + rows[:40], "doc_id long, text string").repartition(5)
    asked = [(1, "hot text"), (2, rows[70][1]), (3, "words " + rows[80][1])]
    assert search(spark, df, asked) == brute(rows + rows[:40], asked)


def test_empty(spark, docs, items):  # noqa: F811
    none = spark.createDataFrame([], "doc_id long, text string")
    assert search(spark, none, items) == [] and search(spark, docs, []) == []
    assert search(spark, docs, [(1, "qqqq zzzzz")]) == []


def test_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL["op12_lexical_search"]).fetchall()
    got = [tuple(r) for r in queries.op12_lexical_search(spark, SF01).collect()]
    assert sorted(got) == sorted(want) and len(got) == 400
