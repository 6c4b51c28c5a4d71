"""Decontamination: items of few shingles in many long documents, against brute force."""

import random

from statlens.llm import decontaminate


def test_short_items_are_found_in_long_documents():
    rng = random.Random(11)
    pool = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(3, 9))) for _ in range(5000)]
    items = [" ".join(rng.choices(pool, k=n)) for n in (5, 6, 7, 8, 10, 15, 40, 60) for _ in range(5)]
    docs = []
    for _ in range(150):
        w = rng.choices(pool, k=rng.randint(500, 3000))
        for item in rng.sample(items, 6):
            at = rng.randrange(len(w))
            w[at:at] = item.split()
        docs.append(" ".join(w).encode())
    sets = [decontaminate.shingle_set(x.encode()) for x in items]
    want = {(d, i, len(s & have)) for d, have in enumerate(map(decontaminate.shingle_set, docs))
            for i, s in enumerate(sets) if len(s & have) >= 0.8 * len(s)}
    block = decontaminate.Items(list(range(len(items))), [x.encode() for x in items], decontaminate.WORDS, decontaminate.THRESHOLD)
    got = list(block.search(list(range(len(docs))), docs))
    assert len(want) > 850 and {x[:3] for x in got} == want and len(got) == len(want)
