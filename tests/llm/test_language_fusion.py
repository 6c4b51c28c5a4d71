"""Language ID: the whole fusion against plain Python, pages that disagree, long texts in parts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from statlens.llm import language_id as L


def is_letter(c):
    return 97 <= c <= 122 or c >= 128


def buckets(text):
    b = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    padded, out = b"\n" + b + b"\n", []
    for i in range(1, len(padded) - 1):
        x, y, z = padded[i - 1:i + 2]
        if is_letter(y) and (is_letter(x) or is_letter(z)) and not any(48 <= c <= 57 for c in (x, z)):
            code = (x * 0x9E3779B1 ^ y * 0x85EBCA6B ^ z * 0xC2B2AE35) & 0xFFFFFFFF
            out.append((code * 0x27D4EB2F & 0xFFFFFFFF) >> 16)
    return out, any(is_letter(c) for c in b)


def softmax(x):
    top = max(x)
    e = [math.exp(v - top) for v in x]
    return [v / sum(e) for v in e]


def brute(rows, web):
    """{(doc_id, text): (lang, posterior, kept)} of ``rows`` (doc_id, text, lang, source)."""
    counts = defaultdict(Counter)
    for _, t, lang, _ in rows:
        if lang is not None and lang != "und" and t:
            counts[lang].update(buckets(t)[0])
    langs = sorted(counts)
    n = len(langs)
    table = [{k: math.log((c + L.SMOOTHING) / (counts[x].total() + L.SMOOTHING * L.BUCKETS)) for k, c in counts[x].items()} for x in langs]
    unseen = [math.log(L.SMOOTHING / (counts[x].total() + L.SMOOTHING * L.BUCKETS)) for x in langs]

    def text(t):
        b, _ = buckets(t)
        ll = [sum(tab.get(k, u) for k in b) for tab, u in zip(table, unseen)] + [-math.log(L.BUCKETS) * len(b)]
        return [x * min(len(b), L.EFFECTIVE) / max(len(b), 1) for x in ll]

    sources = defaultdict(list)
    for i, t, _, s in rows:
        sources[i, None if i is not None else t].append(s)
    pages = defaultdict(list)
    for i, *page in web:
        if i is not None:
            pages[i].append(page)

    def places(i, t):
        source = min((s for s in sources[i, None if i is not None else t] if s is not None), default=None)
        own = pages.get(i) or [(None, None, None, None)]
        return [(s or "-", d or "-", h or ("-" + source if source is not None else "-"), 1 / len(own)) for _, s, d, h in own]

    prior = [math.log((1 - L.UND_PRIOR) / n)] * n + [math.log(L.UND_PRIOR)]
    at = defaultdict(lambda: np.zeros(n + 1))
    for i, t, _, _ in rows:
        post = softmax([a + b for a, b in zip(text(t), prior)])
        for s, d, h, w in places(i, t):
            at[s, d, h] += np.array(post) * w
    total = lambda keep: sum((v for k, v in at.items() if keep(k)), np.zeros(n + 1))
    whole = total(lambda k: True) + 1 / (n + 1)
    whole = whole / whole.sum()
    smooth = lambda c, p: (c + L.STRENGTH * p) / (c.sum() + L.STRENGTH)
    out = {}
    for i, t, _, _ in rows:
        log = np.array(text(t))
        for s, d, h, w in places(i, t):
            p1 = smooth(total(lambda k: k[0] == s), whole)
            p2 = smooth(total(lambda k: k[:2] == (s, d)), p1)
            log += w * (np.log(smooth(at[s, d, h], p2)) + 0.5 * np.log(p1 / whole))
        known = [x[0].lower() for x in pages.get(i, []) if x[0] and x[0].lower() in langs]
        for x in known:
            log += np.array([math.log(L.DECLARED if x == y else (1 - L.DECLARED) / n) for y in [*langs, "und"]]) / len(known)
        p = softmax(log)
        best = int(np.argmax(p))
        lang = [*langs, "und"][best] if buckets(t)[1] else "und"
        out[i, t] = lang, p[best] if buckets(t)[1] else 1.0, lang != "und" and p[best] >= L.LEAST_POSTERIOR
    return out


@pytest.fixture(scope="module")
def case():
    rng = random.Random(6)
    make = {"xa": "abcde ", "xb": "cdefg ", "xc": "efghi "}
    rows = [(i, "".join(rng.choice(make[x]) for _ in range(rng.choice([4, 30, 200]))), x if i % 4 else None, f"s{i % 7}" if i % 5 else None)
            for i, x in enumerate(list(make) * 20)]
    rows += [(100, None, "xa", "s1"), (101, "12 !", None, None), (102, "Q", None, "s0"), (None, "abab abcb", None, "s2"), (None, "efgh", "xc", None), (103, "日本", None, "s1")]
    web = []
    for i in range(0, 50, 2):
        for k in range(rng.choice([1, 1, 2, 5])):
            web.append((i, rng.choice([None, "XA", "xb", "zz", "xc"]), rng.choice(["a", "b", None]), rng.choice(["d.a", "e.b"]), rng.choice(["h.d.a", "k.e.b", None])))
    return rows, web + [(None, "xa", "a", "d.a", "h.d.a"), (999, "xa", "a", "d.a", "h.d.a"), web[0], (102, "xa", "a", "d.a", "h.d.a"), (102, "xc", "b", "e.b", "k.e.b"), (102, "xc", "b", "e.b", "k.e.b")]


def test_fusion_against_plain_python(spark, case):
    rows, web = case
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    pages = spark.createDataFrame(web, "doc_id long, declared string, suffix string, domain string, host string").repartition(2)
    want = brute(rows, web)
    found = L.identify(spark, docs, pages).collect()
    assert len(found) == len(rows)
    by = {i: v for (i, _), v in want.items() if i is not None}
    for r in found:
        if r.doc_id is not None:
            lang, p, kept = by[r.doc_id]
            assert r.posterior == pytest.approx(p, rel=2e-3, abs=1e-6) and r.kept == kept and r.lang == lang, r
    assert sorted((r.lang, round(r.posterior, 2)) for r in found if r.doc_id is None) == sorted((v[0], round(v[1], 2)) for (i, _), v in want.items() if i is None)
    assert len({v[0] for v in want.values()}) == 4


def test_all_pages_of_a_document_count(spark):
    long_tag = "<html " + "data-x='" + "y" * 300 + "' lang=\"XB\"><body>"
    pages = [("http://h.d.a/7", '<HTML LANG="xa">'), ("https://u@k.e.b:80/7.html?q", long_tag), ("http://z.e.b/7", "<p lang=xc>"), ("http://h.d.a/x", "<html lang=xa>"),
             ("http://h.d.a/1234567890123456789/", "<html lang=xa>"), ("http://h.d.a/99999999999999999999", "<html lang=xa>"), (None, None)]
    from statlens.llm.queries import page_document

    df = spark.createDataFrame(pages, "url string, html string")
    got = sorted(tuple(r) for r in L.web_evidence(df, page_document()).na.fill("-").collect())
    assert got == [(7, "-", "z.e.b", "b", "e.b"), (7, "xa", "h.d.a", "a", "d.a"), (7, "xb", "k.e.b", "b", "e.b"), (1234567890123456789, "xa", "h.d.a", "a", "d.a")]


def test_long_texts_are_taken_in_parts():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc éß1 .") for _ in range(k)).encode() for k in (0, 1, 2, 63, 64, 65, 700, 5)]
    for limit in (1, 2, 7, 64, 1000):
        got, letters = defaultdict(Counter), set()
        for bucket, at, lettered in L.trigram_blocks(texts, limit):
            for k, i in zip(bucket.tolist(), at.tolist()):
                got[i][k] += 1
            letters.update(lettered.tolist())
        for i, t in enumerate(texts):
            b = bytes(c + 32 if 65 <= c <= 90 else c for c in t)
            padded = b"\n" + b + b"\n"
            want = Counter()
            for k in range(1, len(padded) - 1):
                x, y, z = padded[k - 1:k + 2]
                if is_letter(y) and (is_letter(x) or is_letter(z)) and not any(48 <= c <= 57 for c in (x, z)):
                    want[((x * 0x9E3779B1 ^ y * 0x85EBCA6B ^ z * 0xC2B2AE35) * 0x27D4EB2F & 0xFFFFFFFF) >> 16] += 1
            assert got[i] == want and (i in letters) == any(map(is_letter, b)), (i, limit)
