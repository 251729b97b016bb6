"""Decontamination at its default parameters: leaks that the latent search alone doesn't reach."""

import random

import numpy as np

from folioloom.llm import decontaminate


def test_items_of_common_words_are_found(spark):
    """Items rest on few telling words, a sixth of the words is changed, and rare words stand around."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    common, rare = [word() for _ in range(60)], [word() for _ in range(6000)]
    docs = [" ".join(rng.choice(common) if rng.random() < 0.7 else rng.choice(rare) for _ in range(rng.randint(150, 400))) for _ in range(200)]
    items = [[rng.choice(rare) if k % 3 == 0 else rng.choice(common) for k in range(rng.randint(15, 24))] for _ in range(60)]
    for k, item in enumerate(items):
        w, changed = docs[k].split(), list(item)
        if k % 2:
            for at in rng.sample(range(len(item)), len(item) // 6):
                changed[at] = rng.choice(rare)
        at = rng.randint(0, len(w))
        around = [rng.choices(rare, k=4) for _ in range(2)]
        docs[k] = " ".join(w[:at] + around[0] + changed + around[1] + w[at:])
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id bigint, text string")
    got = {(r["doc_id"], x["item_id"]) for r in decontaminate.flag(df, bench).collect() for x in r["leaks"]}
    assert got == {(k, k) for k in range(60)}


def test_windows_beside_a_higher_cosine_are_checked():
    """Past the passage the cosine rises still, and no three of the item's words stand in a row."""
    item = [f"i{k}" for k in range(24)]
    spread = [w for k in range(0, 24, 2) for w in (*item[k : k + 2], f"x{k}")]  # 36 words: a word after each two
    passage = ["y"] * 8 + spread[:20] + ["noise", *spread[21:]]
    text = " ".join(passage + ["y"] * 4 + [w for n in (1, 2, 3, 4, 5) for w in [item[0]] * n + ["y"] * (8 - n)]).encode()
    table = np.zeros((decontaminate.TERMS, 2), np.float32)
    term = lambda w: decontaminate.words([w.encode()])[0][0] % decontaminate.TERMS
    for w in item:
        table[term(w)] = (0.1, 0)
    table[term(item[0])] = (1, 0)
    table[term("noise")] = (0, 1)
    known = decontaminate.Items([(1, " ".join(item))], table, 0.75, 0.6, 8)
    ids, n = decontaminate.words([text])
    found = [{}]
    decontaminate._find(ids, n, table, known, found, 0.75)
    assert found[0].keys() == {0}  # by its place among the items


def test_planted_leaks_at_the_default_cosine(spark):
    """The cases of test_copies.test_leaks, at the threshold of production."""
    rng = random.Random(9)
    vocab = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(4000)]
    items = [" ".join(rng.choices(vocab, k=rng.randint(16, 60))) for _ in range(30)]
    docs = [" ".join(rng.choices(vocab, k=rng.randint(60, 400))) for _ in range(200)]
    for k in range(0, 30, 2):
        w = docs[k].split()
        at = rng.randint(0, len(w))
        item = items[k].split()
        if k % 4 == 0:  # a paraphrase: some words in the middle differ
            item[3 : 3 + len(item) // 6] = rng.choices(vocab, k=len(item) // 6)
        docs[k] = " ".join(w[:at] + item + w[at:])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = decontaminate.flag(spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string"), bench).collect()
    assert {(r["doc_id"], x["item_id"]) for r in got for x in r["leaks"]} == {(k, k) for k in range(0, 30, 2)}
