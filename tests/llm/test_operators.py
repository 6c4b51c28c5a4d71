"""Each operator against brute force, on a small table with nulls, empty and long texts, ties and repeats."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from statlens.llm import (decontaminate, exact_dedup, language_id, packing, sentence_dedup, simhash_dedup, suffix_dedup,
                          toxicity, url_filter, warc)
from statlens.llm.common import keep_rows

DOC = "doc_id long, text string, lang string, source string, chunk string, fp long, bin int"


def prose(rng, words):
    w = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(words)]
    for i in range(0, words, 9):
        w[i] = w[i].capitalize()
        if i:
            w[i - 1] += "."
    return " ".join(w) + "."


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text): copies, near copies, shared passages, junk, and the edge cases."""
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 40, 120, 300])) for _ in range(40)]
    passage = prose(rng, 90)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i].upper() if i % 2 else base[i]) for i in range(15)]
    rows += [(200 + i, base[i] + " " + passage + " " + prose(rng, 30)) for i in range(12)]
    rows += [(300 + i, base[20 + i].replace(" ", "  ").replace("a", "a", 1)) for i in range(5)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "x" * 3000), (404, "Äé ßü. " * 500), (405, prose(rng, 9000)),
             (406, "ab" * 900), (407, "!!! ???"), (None, base[0]), (None, None), (0, base[0]), (0, base[0])]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, random.Random(str(i)).choice(["en", "de"]) if i != 3 else None, "s" if (i or 0) % 3 else None, "c", 1, 2) for i, t in texts]
    return spark.createDataFrame(rows, DOC).repartition(3)


def low(text):
    return (text or "").encode().lower().decode()


def test_exact_dedup(spark, docs, texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[low(t)].append(i)
    want = Counter()
    for i, t in texts:
        g = groups[low(t)]
        keep = max((x for x in g if x is not None), default=None)
        want[i, keep, len(g), i == keep, hashlib.sha256(low(t).encode()).hexdigest()] += 1
    assert Counter(map(tuple, exact_dedup.exact_duplicates(spark, docs).collect())) == want


def test_exact_dedup_with_clashing_identifiers(spark, docs):
    """Identifiers that clash are found out, and other seeds taken, so results are the same."""
    def weak(chunk, seed):
        return F.when(F.lit(seed) < 4, F.struct(F.length(chunk).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))).otherwise(
            exact_dedup.identifier(chunk, seed))

    got = exact_dedup.exact_duplicates(spark, docs, make=weak).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, exact_dedup.exact_duplicates(spark, docs).collect()))


def test_chunks_rebuild_the_text(spark, docs):
    got = docs.where("text IS NOT NULL").select("text", exact_dedup.chunks(F.col("text")).alias("c")).collect()
    assert all("".join(r.c) == r.text and all(len(c) <= exact_dedup.MAX_CHUNK for c in r.c) for r in got)


def simhash(text):
    w = low(text).encode().split()
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def components(fps, radius=3):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    fps = list(root)
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_simhash(spark, docs, texts):
    prints = [(i, simhash(t)) for i, t in texts if i is not None]
    root = components({f for _, f in prints})
    least = {}
    for i, f in prints:
        least[root[f]] = min(i, least.get(root[f], i))
    got = simhash_dedup.near_duplicates(spark, docs).collect()
    assert Counter((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in got) == Counter((i, f, least[root[f]]) for i, f in prints)


@pytest.mark.parametrize("shard", [4, 4096])
def test_bk_tree_links_dense_groups_and_chains(spark, shard):
    """Clusters larger than a shard, chains of links, and strays: the components are brute force's."""
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(4)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(40)}
    chain = rng.getrandbits(64)
    for b in range(0, 30, 3):
        fps.add(chain := chain ^ (7 << b))
    fps |= {rng.getrandbits(64) for _ in range(50)}
    df = spark.createDataFrame([(simhash_dedup.signed(f),) for f in fps], "fp long")
    found = simhash_dedup.components(spark, simhash_dedup.links(spark, df, shard=shard)).collect()
    got = defaultdict(set)
    for r in found:
        got[r.root].add(r.node % 2 ** 64)
    want = defaultdict(set)
    for f, r in components(fps).items():
        want[r].add(f)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_decontaminate(spark, docs, texts):
    long_ = next(t for i, t in texts if i == 405)
    words = long_.split()
    items = [(1, " ".join(words[50:70])), (2, " ".join(words[4000:4015]).upper()), (3, "too few words"), (4, None), (5, ""),
             (6, " ".join(words[10:40] + [f"zz{k}" for k in range(40)])), (7, " ".join(words[100:130] + ["zz", "yy"])), (None, "a b c d e f"), (1, " ".join(words[50:70]))]
    want = {}
    for i, t in texts:
        have = decontaminate.shingle_set((t or "").encode())
        for k, s in items:
            own = decontaminate.shingle_set((s or "").encode())
            if None not in (i, k) and own and len(own & have) >= 0.8 * len(own):
                want[i, k] = len(own & have)
    assert {k for _, k in want} == {1, 2, 7}
    frame = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 64):  # one block of items, and several
        got = decontaminate.contained_items(spark, docs, frame, block=block).collect()
        assert {(r.doc_id, r.item_id): r.shared for r in got} == want and len(got) == len(want)


def test_suffix_dedup(spark, docs, texts):
    size = 64
    for length, gram, window in ((size, 8, 32), (400, 32, 256)):
        count = Counter(t.encode()[p:p + length] for _, t in texts if t for p in range(len(t.encode()) - length + 1))
        want = Counter()
        for i, t in texts:
            b = (t or "").encode()
            cut = np.zeros(len(b) + 1, bool)
            for p in range(len(b) - length + 1):
                if count[b[p:p + length]] > 1:
                    cut[p:p + length] = True
            kept = bytes(x for x, c in zip(b, cut) if not c)
            runs = int((np.diff(np.r_[False, cut].astype(int)) == 1).sum())
            want[i, len(b), int(cut.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
        got = suffix_dedup.dedup_bytes(spark, docs, length, gram, window).collect()
        assert Counter(tuple(r)[:5] for r in got) == want


def test_sentence_dedup(spark, docs, texts):
    split = {}
    seen, gone = set(), defaultdict(set)
    for i, t in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode(), 42))):
        b = (t or "").encode()
        ends, words = sentence_dedup.sentences(b)
        assert (ends[-1] if ends else 0) == len(b) and ends == sorted(set(ends))
        if (i, b) in split:
            continue
        split[i, b] = ends
    order = sorted(split, key=lambda k: (k[0] is not None, k[0] or 0, np.uint64(xxhash.xxh64_intdigest(k[1], 42)).astype(np.int64)))
    for key in order:
        for a, e, s in sentence_dedup.spans(sentence_dedup.sentences(key[1])[1]):
            if s in seen:
                gone[key].update(range(a, e))
            seen.add(s)
    got = sentence_dedup.dedup_sentences(spark, docs).collect()
    want = Counter()
    for i, t in texts:
        key = i, (t or "").encode()
        ends = [0, *split[key]]
        want[i, b"".join(key[1][a:e] for k, (a, e) in enumerate(zip(ends, ends[1:])) if k not in gone[key]).decode()] += 1
    assert Counter((r.doc_id, r.text) for r in got) == want
    assert all(r.kept_sha256 == hashlib.sha256(r.text.encode()).hexdigest() and r.n_removed == r.n_bytes - len(r.text.encode()) for r in got)
    assert sum(r.n_removed > 0 for r in got if r.doc_id and 200 < r.doc_id < 212) == 11


def test_packing(spark, docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    capacity, want = 500, Counter()
    odd = [(900, "naïve İstanbul ΣΑΣ it's <|endoftext|>x\u0301 a\x1cb\u2028c don't 12,5 ...—"), (901, "e\u0301 Ǆ ﬁ")]
    for i, t in texts + odd:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, a in enumerate(range(0, len(ids), capacity)):
            want[i, k, a, len(ids[a:a + capacity]), zlib.crc32(ids[a:a + capacity].tobytes())] += 1
    more = spark.createDataFrame([(i, t, "en", "s", "c", 1, 2) for i, t in odd], DOC)
    pieces = packing.token_pieces(docs.union(more), capacity=capacity)
    got = packing.pack(spark, pieces, capacity, shard=50).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for v in sequences.values():
        at = 0
        for off, n in sorted(v):
            assert off == at
            at += n
        assert at <= capacity
    size = np.array([r.length for r in got])
    whole_bins = packing.best_fit(np.argsort(-size, kind="stable"), size.tolist(), {}, [0] * len(size), capacity, 0)
    assert math.ceil(size.sum() / capacity) <= len(sequences) <= whole_bins + 1


def test_genetic_packing_beats_or_equals_best_fit():
    rng = np.random.default_rng(3)
    size = rng.integers(200, 700, 150)
    bins = packing.evolve(size, [], 1000, seed=1)
    first = [0] * len(size)
    packing.best_fit(np.argsort(-size, kind="stable"), size.tolist(), {}, first, 1000, 0)
    assert np.bincount(bins, size).max() <= 1000 and packing.fitness(bins, size, 1000) <= packing.fitness(np.array(first), size, 1000)


def test_whole_packing_beats_best_fit_strictly(spark):
    """Sizes on which best fit in decreasing order needs more bins than the genetic search finds, over several shards."""
    rng = np.random.default_rng(3)
    size = rng.integers(200, 700, 300)
    df = spark.createDataFrame([(int(n), "x") for n in size], "length long, bin string")
    got = packing.pack(spark, df, capacity=1000, shard=150).toPandas()
    load = got.groupby("sequence_id")["length"].sum()
    assert len(got) == len(size) and sorted(got["length"]) == sorted(size) and load.max() <= 1000
    first = [0] * len(size)
    order = np.argsort(-size, kind="stable")
    packing.best_fit(order, size.tolist(), {}, first, 1000, 0)
    assert len(load) < len(set(first))


def test_warc(spark, tmp_path):
    pages = [(1, "http://a.org/1", "<p>x</p>"), (2, "http://b.org/2", "<p>x</p>"), (3, None, None), (4, "http://c\r\nWARC-Type: x", ""),
             (5, "http://d", "é" * 100_000), (6, "http://e", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"), (None, "http://f", "<p>x</p>"),
             (None, "http://g", "only here"), (2, "http://b.org/2", "<p>x</p>"), (7, "http://d", "é" * 100_000)]
    df = spark.createDataFrame([(*p, "junk") for p in pages], "page_id long, url string, html string, mark string")
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    for least in (0, 9):
        manifest = warc.write_archives(spark, df, f"file://{tmp_path}/a{least}", least)
        chunks = warc.read_archives(manifest, chunk=1000).collect()
        want = Counter()
        for i, _, h in pages:
            b = (h or "").encode()
            origin = first.get(h or "") if len(b) >= least else None
            refers = None if origin is None or origin == i else origin
            want[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if refers is None else "revisit", refers] += 1
        assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in chunks if r.last) == want
        long_ = sorted((r for r in chunks if r.page_id == 5), key=lambda r: r.chunk)
        payload = b"".join(r.data for r in long_)
        assert payload == pages[4][2].encode() and all(len(r.data) <= 1000 for r in long_)
        assert [r.running_sha1 for r in long_] == [hashlib.sha1(payload[:1000 * (k + 1)]).hexdigest() for k in range(len(long_))]


def test_url_filter(spark):
    urls = [(1, "https://A.Example.ORG/en/1x?q#f"), (2, "http://example.org/es/a"), (3, "ftp://x.com"), (4, "http://x.com/fr/"), (5, "http://notcom/fr/"),
            (6, "no url"), (7, None), (8, "http://bad.net/a"), (9, "http://bad.net/b"), (10, "http://good.net/a://b/?"), (11, "http://org/"), (11, "http://org/"), (None, "http://com/de/x")]
    pages = spark.createDataFrame([(*u, 0.0) for u in urls], "page_id long, url string, bound double")
    outcomes = spark.createDataFrame([(i, g) for i, g in [(8, 0), (9, 0), (10, 1), (3, 1), (None, 1), (4, None), (5, 7)]], "page_id long, good int")
    got = {r.page_id: r for r in url_filter.judge_urls(spark, pages, outcomes).collect()}
    assert [(got[i].host, got[i].path) for i in (1, 3, 6, 7, 10)] == [
        ("a.example.org", "/en/1x"), ("x.com", ""), ("", ""), ("", ""), ("good.net", "/a://b/")]
    assert [got[i].rule for i in (1, 2, 3, 4, 5, 11, None)] == ["example.org/en/1", "example.org/es/", None, "com/fr/", None, "org/", "com/de/"]
    assert [got[i].verdict for i in (1, 2, 4, 11, None)] == ["block", "block", "allow", "allow", "block"]
    assert got[8].bound < got[10].bound
    assert url_filter.judge_urls(spark, pages, outcomes).count() == len(urls)


def test_url_reputation_shrinks_towards_the_parent(spark):
    hosts = [("a.x.com", 1000, 900), ("b.x.com", 1000, 100), ("new.x.com", 0, 0), ("one.x.com", 1, 0), ("c.y.com", 50, 50), ("", 2, 1)]
    got = {r.host: r for r in url_filter.host_reputation(spark, spark.createDataFrame(hosts, "host string, n long, s long")).collect()}
    assert abs(got["a.x.com"].mean - 0.9) < 0.02 and abs(got["b.x.com"].mean - 0.1) < 0.02
    assert 0 < got["one.x.com"].mean < got["new.x.com"].mean < got["c.y.com"].mean
    assert all(r.bound < r.mean for r in got.values())


def test_language_id(spark):
    rng = random.Random(2)
    make = {"xa": "abcde ", "xb": "fghij ", "xc": "klmno "}
    rows = [(i, "".join(rng.choice(make[x]) for _ in range(200)), x, f"s{i % 3}") for i, x in enumerate(list(make) * 30)]
    ask = [(1000, "fghij fghijj gfh", None, "s1"), (1001, None, None, None), (1002, "  123?! ", None, "s1"), (1003, "q", None, "s2"),
           (1004, "ЖЩЮ ЙЪЭ ЖЩЮ ЙЪЭ ЮЖЩ", None, "s1"), (None, "abc", "xa", "s1"), (1005, "!!!", "xa", "s1")]
    docs = spark.createDataFrame([(*r, 9) for r in rows + ask], "doc_id long, text string, lang string, source string, post int")
    web = spark.createDataFrame([(1003, "XC", "c", "x.c", "w.x.c"), (4, None, "c", "x.c", "w.x.c")], "doc_id long, declared string, suffix string, domain string, host string")
    got = {r.doc_id: r for r in language_id.identify(spark, docs, web).collect()}
    assert all(got[i].lang == x and got[i].kept for i, _, x, _ in rows)
    assert got[1000].lang == "xb" and got[1000].kept
    assert got[1003].lang == "xc"  # no trigram is known: the declared language decides
    assert [(got[i].lang, got[i].kept) for i in (1001, 1004, 1005)] == [("und", False)] * 3
    kept = language_id.drop_unidentified(spark, docs, web)
    assert kept.columns == docs.columns and kept.where("doc_id IS NULL").count() == 1
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang for r in language_id.identify(spark, unlabelled, web).collect()} == {"und"}


def test_toxicity_gradients():
    texts = [b"you are an idiot and a clown of the world " * 3, b"the quick brown fox jumps", b"", b"a b c d e f g h"]
    words = toxicity.Words(texts)
    m = toxicity.new_model(words.hashes[::2])
    label = np.array([1, 0, 0, 1])[words.text].astype(np.float32)
    which = np.arange(len(words.text))
    grad = toxicity.gradients(m, words, which, label)

    def loss(m):
        x = words.inputs(m)
        out = toxicity.forward(m, {k: x @ m["W" + k] + m["b" + k] for k in "fb"}, *words.ids(which)).astype(float)
        return np.mean(np.logaddexp(0, out) - label * out)

    for k, v in grad.items():
        j, e = int(np.argmax(np.abs(v))), 0.03
        up, down = ({a: b.copy() for a, b in m.items()} for _ in range(2))
        up[k].ravel()[j] += e
        down[k].ravel()[j] -= e
        assert abs((loss(up) - loss(down)) / (2 * e) - v.ravel()[j]) < 1e-3


def test_toxicity(spark):
    rng = random.Random(4)
    rows = []
    for i in range(500):
        w = prose(rng, rng.choice([20, 60, 200])).split()
        if i % 4 == 0:
            for _ in range(1 + len(w) // 20):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "scum", "moron"]))
        rows.append((i, " ".join(w)))
    edge = [(1000, None), (1001, ""), (1002, "!!"), (None, "you idiot"), (0, rows[0][1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows + edge], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(500)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.score_documents(spark, docs, labels).collect()
    assert len(got) == len(rows) + len(edge) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [(r.predicted, int(r.doc_id % 4 == 0)) for r in got if r.held_out and r.doc_id < 500]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)
    none = labels.where("toxic = 0")
    assert {r.score for r in toxicity.score_documents(spark, docs, none).collect()} == {0.0}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOC)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    web = spark.createDataFrame([], "doc_id long, declared string, suffix string, domain string, host string")
    for out in (exact_dedup.exact_duplicates(spark, docs), simhash_dedup.near_duplicates(spark, docs), decontaminate.contained_items(spark, docs, items),
                suffix_dedup.dedup_bytes(spark, docs), sentence_dedup.dedup_sentences(spark, docs), packing.packed_documents(spark, docs),
                warc.archive_and_read(spark, pages), url_filter.judge_urls(spark, pages, labels.selectExpr("doc_id AS page_id", "toxic AS good")),
                language_id.identify(spark, docs, web), toxicity.score_documents(spark, docs, labels)):
        assert out.count() == 0 and out.columns


def test_keep_rows_holds_nulls_equal(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "doc_id long, __id string")
    ids = spark.createDataFrame([(None,), (2,)], "doc_id long")
    df = df.withColumnRenamed("__id", "x")
    assert {r.x for r in keep_rows(df, ids).collect()} == {"b", "c"} and {r.x for r in keep_rows(df, ids, keep=False).collect()} == {"a"}
