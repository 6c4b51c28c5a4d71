"""Stage decisions hold for a row's id and text: other texts under the same id, or without one, are judged for themselves."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from test_operators import components, low, prose, simhash

import corpus_pipeline
from statlens.llm import decontaminate, exact_dedup, language_id, packing, simhash_dedup
from statlens.llm.common import staged

DOC = "doc_id long, text string, lang string, source string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "xa", "s") for i, t in rows], DOC).repartition(3)


def left(df):
    assert df.columns == ["doc_id", "text", "lang", "source"]
    return Counter((r.doc_id, r.text) for r in df.collect())


def near(text, k=1):
    """``text`` with ``k`` words more, within the radius of its fingerprint."""
    for n in range(1000):
        other = f"{text} end{n}" + " and" * (k - 1)
        if (simhash(text) ^ simhash(other)).bit_count() <= 3:
            return other


def test_exact(spark):
    rows = [(1, "same text"), (5, "SAME text"), (1, "other text"), (None, "same text"), (None, "clean"), (None, None), (2, "")]
    assert left(exact_dedup.drop_exact_duplicates(spark, table(spark, rows))) == Counter([rows[1], rows[2], rows[4], rows[6]])


def test_near(spark):
    rng = random.Random(3)
    a, b, c, d, e = (prose(rng, 400) for _ in range(5))
    rows = [(1, a), (2, near(a)), (2, b), (None, near(a, 2)), (None, c), (None, d), (9, near(d)), (None, e), (None, near(e))]
    got = left(simhash_dedup.drop_near_duplicates(spark, table(spark, rows)))
    one = Counter(k for k in got.elements() if k in rows[7:])
    assert got - one == Counter([rows[0], rows[2], rows[4], rows[6]]) and sum(one.values()) == 1


def test_contaminated(spark):
    rng = random.Random(4)
    item, texts = prose(rng, 20), [prose(rng, 60) for _ in range(4)]
    rows = [(1, texts[0] + " " + item), (1, texts[1]), (None, texts[2] + " " + item), (None, texts[3])]
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert left(decontaminate.drop_contaminated(spark, table(spark, rows), items)) == Counter([rows[1], rows[3]])
    found = decontaminate.contained_items(spark, table(spark, rows), items).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in found) == [(0, 7), (1, 7)]


def test_unidentified(spark):
    rng = random.Random(6)
    known = [(100 + i, prose(rng, 30)) for i in range(30)]
    rows = [(1, "ЖЩЮ ЙЪЭ ЖЩЮ ЙЪЭ ЮЖЩ"), (1, prose(rng, 20)), (None, "ЭЙЮ ЩЖЪ ЭЙЮ ЩЖЪ ЖЩ"), (None, prose(rng, 20)), (None, "123"), (None, None)]
    docs = spark.createDataFrame([(i, t, "xa" if i and i >= 100 else None, "s") for i, t in known + rows], DOC).repartition(3)
    web = spark.createDataFrame([(1, None, "c", "x.c", "w.x.c")], "doc_id long, declared string, suffix string, domain string, host string")
    assert left(language_id.drop_unidentified(spark, docs, web)) == Counter([*known, rows[1], rows[3]])
    assert language_id.identify(spark, docs, web).count() == len(known) + len(rows)


def test_pipeline_against_brute_force(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(7)
    base, items = [prose(rng, 200) for _ in range(40)], [prose(rng, 20) for _ in range(3)]
    rows = [(i, t) for i, t in enumerate(base[:25])]
    rows += [(100 + i, base[i].upper()) for i in range(5)] + [(i, prose(rng, 150)) for i in range(5)]  # copies, and other texts under a copy's id
    rows += [(None, base[i]) for i in range(3)] + [(None, prose(rng, 150)) for _ in range(4)]
    rows += [(200 + i, near(base[5 + i])) for i in range(4)] + [(200 + i, prose(rng, 150)) for i in range(4)] + [(None, near(base[10]))]
    rows += [(300 + i, base[30 + i] + " " + items[i % 3]) for i in range(4)] + [(300 + i, prose(rng, 150)) for i in range(4)]
    rows += [(None, prose(rng, 90) + " " + items[0]), (None, "12 34"), (None, None), (400, "!!"), (400, prose(rng, 60)), (401, None), (0, base[0]), (24, base[24]), (24, base[24])]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "http://a.org/3", "<html lang=xa>"), (2, "http://b.org/x", None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    stay = [(i, t) for i, t in rows if any("a" <= c <= "z" for c in low(t))]
    most = defaultdict(lambda: -1)
    for i, t in stay:
        most[low(t)] = max(most[low(t)], -1 if i is None else i)
    stay = [(i, t) for i, t in stay if (-1 if i is None else i) == most[low(t)]]
    root, least = components({simhash(t) for _, t in stay}), {}
    for i, t in stay:
        r = root[simhash(t)]
        least[r] = min(least.get(r, (True, 0, "")), (i is None, i or 0, t)) if r in least else (i is None, i or 0, t)
    stay = [(i, t) for i, t in stay if least[root[simhash(t)]] == (i is None, i or 0, t)]
    hold = [decontaminate.shingle_set(x.encode()) for x in items]
    stay = [(i, t) for i, t in stay if not any(len(h & decontaminate.shingle_set(t.encode())) >= 0.8 * len(h) for h in hold)]
    assert {i for i, _ in stay} >= {None, 0, 100, 200, 300, 400} and len(stay) < len(rows) - 20

    whole = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter()
    for i, t in stay:
        ids = np.array([*whole.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, str(tmp_path)), f"stage-{name}")
    assert left(docs) == Counter(stay)
    assert Counter((r.doc_id, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == want
