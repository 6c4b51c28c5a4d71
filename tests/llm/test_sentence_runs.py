"""Sentence dedup: all repeated runs, and passages inside long text without stops."""

import random
from collections import Counter

from statlens.llm import sentence_dedup

DOC = "doc_id long, text string"


def words(rng, n):
    return ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(4, 8))) for _ in range(n)]


def sentence(rng, n):
    return " ".join(words(rng, n)) + ". "


def every_run(rows, least=2, least_words=12):
    """What is left of each row's text when all sentences in any repeated run are gone but the first's: all runs are tried."""
    seen, left = set(), {}
    for i, t in sorted(rows):
        b = t.encode()
        ends, own = sentence_dedup.sentences(b)
        gone, new = set(), []
        for a in range(len(own)):
            for e in range(a + least, len(own) + 1):
                if sum(map(len, own[a:e])) >= least_words:
                    run = tuple(map(tuple, own[a:e]))
                    if run in seen:
                        gone.update(range(a, e))
                    seen.add(run)
        ends = [0, *ends]
        left[i] = b"".join(b[x:y] for k, (x, y) in enumerate(zip(ends, ends[1:])) if k not in gone).decode()
    return left


def test_the_tail_of_a_repeated_run_goes(spark):
    rng = random.Random(8)
    shared = sentence(rng, 6) + sentence(rng, 6) + sentence(rng, 3)
    pool = [sentence(rng, rng.choice([1, 2, 3, 5, 8, 13])) for _ in range(60)]
    rows = [(1, sentence(rng, 9) + shared + sentence(rng, 9)), (2, sentence(rng, 7) + shared + sentence(rng, 8))]
    for i in range(10, 50):  # runs of the pool, at random places
        a = rng.randrange(50)
        rows.append((i, sentence(rng, 4) + "".join(pool[a:a + rng.randint(2, 10)]) + sentence(rng, 4) + "".join(pool[:rng.randint(0, 4)])))
    got = {r.doc_id: r.text for r in sentence_dedup.dedup_sentences(spark, spark.createDataFrame(rows, DOC).repartition(3)).collect()}
    assert got == every_run(rows)
    assert not any(w in got[2] for w in shared.replace(".", "").split())


def test_a_passage_at_other_offsets_of_text_without_stops_goes(spark):
    rng = random.Random(9)
    for _ in range(200):
        passage = words(rng, 60)
        both = [Counter(s for _, _, s in sentence_dedup.spans(sentence_dedup.sentences(" ".join(
            words(rng, lead) + passage + words(rng, 90)).encode())[1])) for lead in (7, 12)]
        assert both[0] & both[1]
    rows, shared = [], [words(rng, 60) for _ in range(20)]
    for k, p in enumerate(shared):
        rows += [(100 * k + j, " ".join(words(rng, lead) + p + words(rng, 50))) for j, lead in enumerate((7, 12, 31))]
    rows += [(9000 + k, " ".join(words(rng, k) + ["one", "two"] * 200 + words(rng, 20))) for k in (50, 51)]  # nothing but a few words
    got = {r.doc_id: r.text for r in sentence_dedup.dedup_sentences(spark, spark.createDataFrame(rows, DOC).repartition(3)).collect()}
    for k, p in enumerate(shared):
        for j in (1, 2):
            assert len(set(p) & set(got[100 * k + j].split())) <= 30
    assert got[9051].split().count("one") < 40


def test_long_sentences_are_covered_by_their_pieces():
    rng = random.Random(10)
    for text in (" ".join(words(rng, 5000)), "x " * 3000, "a,b-c;" * 900, "... " + " !! ".join(words(rng, 300)) + " !!! ", "é " * 100, "a b " * 500):
        b = text.encode()
        ends, own = sentence_dedup.sentences(b)
        assert ends[-1] == len(b) and ends == sorted(set(ends)) and max(map(len, own)) <= 40 and min(map(len, own)) >= 1
        assert [w for x in own for w in x] == b.translate(sentence_dedup._TABLE).split()
