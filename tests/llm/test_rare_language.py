"""Language ID: a rare language beside a large one."""

import random

from statlens.llm import language_id


def test_a_rare_language_has_a_table(spark):
    rng = random.Random(12)
    rows = [(i, "".join(rng.choice("abcde ") for _ in range(120)), "xa", "s1") for i in range(2000)]
    rows += [(5000 + i, "".join(rng.choice("жщюйъэ ") for _ in range(120)), "xb", "s1") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    web = spark.createDataFrame([], "doc_id long, declared string, suffix string, domain string, host string")
    for sample in (20, 4000):  # part of the large language, and all rows
        got = {r.doc_id: r for r in language_id.identify(spark, docs, web, sample).collect()}
        assert all(got[i].lang == lang and got[i].kept for i, _, lang, _ in rows)
    taken = language_id.trigram_counts  # the large language's part stays bounded
    seen = []
    try:
        language_id.trigram_counts = lambda df: (seen.append({r.lang: r["count"] for r in df.groupBy("lang").count().collect()}), taken(df))[1]
        language_id.fit(spark, docs, 100)
    finally:
        language_id.trigram_counts = taken
    assert seen[0]["xb"] == 8 and 60 <= seen[0]["xa"] <= 140
