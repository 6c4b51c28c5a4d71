"""Token-id files: the coder's round trip, damaged blocks, and the files against the whole tokenizer."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statlens.llm import id_coder, queries, token_files, word_tokens
from tests.llm.test_operators import docs, prose, texts  # noqa: F401


def whole():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))


def brute(rows):
    """(doc_id, ids) of the rows in file order but for rows that repeat an id."""
    tok = whole()
    return [(i, [*tok.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0, 1, 2, 2047, 2048, 2049, 9000]), st.integers(0, 1 << 30), st.sampled_from([1, 3, 300, 49408])), min_size=1, max_size=4))
def test_coder_round_trip(shapes):
    blocks = [np.random.default_rng(seed).integers(0, top, n) for n, seed, top in shapes]
    coded = id_coder.encode(blocks)
    for a, b in zip(blocks, id_coder.decode(coded)):
        assert np.array_equal(a, b)
    for a, c in zip(blocks, coded):  # each block decodes alone
        assert np.array_equal(a, id_coder.decode([c])[0])


def test_coder_learns_and_rejects_damage():
    rng = np.random.default_rng(3)
    text = np.tile(rng.integers(0, 500, 5000), 20)
    coded = id_coder.encode([text])[0]
    assert len(coded) * 8 < 7 * len(text)  # order 0 alone needs 9 bits an id
    assert id_coder.encode([]) == [] and id_coder.decode([]) == []
    for at in (0, 9, 40, len(coded) - 1):
        bad = bytearray(coded)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            id_coder.decode([bytes(bad)])
    with pytest.raises(ValueError):
        id_coder.decode([coded[:-4]])
    for wrong in (np.array([1 << 16]), np.zeros(id_coder.BLOCK + 1, int)):
        with pytest.raises(ValueError):
            id_coder.encode([wrong])


def test_word_tokenizer_against_whole():
    tok, words = whole(), word_tokens.word_tokenizer(token_files.TOKENIZER)
    given_ = ["", " ", "It's don't ÄÖÞ× ÷ß Ÿ İstanbul a b x,y 12,5 日本 \U0001f600 <|endoftext|> é K ſ Å", "\x1c a\x85b\xa0c 'tis abc' !!! !!!, A!!!",
              "naïve Éx Ñ. ÀÿÞ×÷ß", "b﻿c (a)(b) a.b. A.B"] + [chr(c) + "x " + "y" + chr(c) for c in range(33, 400)]
    for _ in range(2):  # the second time from the kept words
        ids, ends = words.encode(pa.array(given_))
        for t, a, b in zip(given_, [0, *ends.tolist()], ends.tolist()):
            assert ids[a:b].tolist() == tok.encode(t, add_special_tokens=False).ids, t


def check(got, rows):
    got, want = got.collect(), brute(rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted((i is not None, i or 0, len(x), crc(x)) for i, x in want)
    got.sort(key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert ids == sorted(ids)
    return got


def test_files(spark, docs, texts):  # noqa: F811
    check(token_files.stored_documents(spark, docs), texts)


def test_many_files_and_blocks(spark, docs, texts, tmp_path):  # noqa: F811
    manifest = token_files.write_token_files(spark, docs.coalesce(1), f"file://{tmp_path}", file_ids=1, block=1000, text_block=20_000)
    assert manifest.count() > 1 and manifest.selectExpr("sum(docs)").first()[0] == len(texts)
    got = check(token_files.read_token_files(spark, manifest, with_ids=True), texts)
    want = {(i, crc(x)): x for i, x in brute(texts)}
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == want[r.doc_id, r.ids_crc32]


def test_a_block_is_read_alone_and_damage_is_seen(spark, tmp_path):
    import random

    rows = [(i, prose(random.Random(i), 400)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    manifest = token_files.write_token_files(spark, df, f"file://{tmp_path}", block=1000)
    path = manifest.first().path.removeprefix("file://")
    all_ids = np.concatenate([x for _, x in brute(rows)])
    with open(path, "rb") as f:
        data = f.read()
    with pa.OSFile(path) as raw:
        file = token_files.Reader(raw)
        assert np.array_equal(file.blocks(3, 4)[0], all_ids[3000:4000])
    with open(path, "wb") as f:
        f.write(data[:5000] + bytes([data[5000] ^ 1]) + data[5001:])
    with pytest.raises(Exception, match="checksum"):
        token_files.read_token_files(spark, manifest).collect()


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, start int")
    assert token_files.stored_documents(spark, empty).collect() == []


def test_query_on_whole_table(spark):
    from tests.conftest import SF001

    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    check(queries.op11_token_files(spark, SF001), [tuple(r) for r in rows])
