"""Decontamination with other ids, very long texts, and paraphrases against a brute-force subsequence search."""

import random

from folioloom.llm import decontaminate as D


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(row[j], old[j + 1])
    return row[-1]


def test_paraphrases_against_brute_force(spark):
    """One word in four, and one in three, is another; the answer stays.  Recall of 0.9 at least, and nothing else."""
    rng = random.Random(31)
    common = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(80)]
    rare = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(5000)]
    word = lambda: rng.choice(common) if rng.random() < 0.5 else rng.choice(rare)
    items = [[word() for _ in range(rng.randint(16, 50))] for _ in range(60)]
    docs = [[word() for _ in range(rng.randint(60, 200))] for _ in range(150)]
    want = set()
    for n, begin in ((4, 0), (3, 60)):
        for k, item in enumerate(items):
            w, d = list(item), docs[begin + k]
            for at in rng.sample(range(len(w) - 8), len(w) // n):
                w[at] = rng.choice(rare)
            at = rng.randint(0, len(d))
            docs[begin + k] = d[:at] + w + d[at:]
            if lcs(item, docs[begin + k]) >= 0.6 * len(item):
                want.add((begin + k, f"item {k}"))
    df = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(f"item {k}", " ".join(t)) for k, t in enumerate(items)], "item_id string, text string")
    got = {(r["doc_id"], x["item_id"]) for r in D.flag(df, bench).collect() for x in r["leaks"]}
    assert len(want) > 100 and len(got & want) >= 0.9 * len(want)
    assert got <= {(k, f"item {k % 60}") for k in range(120)}


def test_a_very_long_text(spark):
    rng = random.Random(7)
    item = [f"i{k}" for k in range(30)]
    long = [f"w{rng.randint(0, 9999)}" for _ in range(1_000_000)]
    text = " ".join(long[:777_777] + item + long[777_777:])
    df = spark.createDataFrame([(1, text), (2, "short"), (3, None)], "doc_id bigint, text string")
    got = D.flag(df, spark.createDataFrame([(5, " ".join(item))], "item_id int, text string")).collect()
    assert {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in got} == {1: [5], 2: [], 3: []}
