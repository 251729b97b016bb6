"""Bands with many near copies, in blocks smaller than the group, against brute force."""

import random

import pytest

from folioloom.llm import simhash


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


@pytest.mark.parametrize(("few", "block", "whole"), [(16, 2000, 4096), (2, 40, 4096), (2, 2000, 64)])
def test_many_near_copies(spark, monkeypatch, few, block, whole):
    monkeypatch.setattr(simhash, "FEW", few)
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SET_WHOLE", whole)
    rng = random.Random(8)
    vocab = ["".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(3000)]
    base = rng.choices(vocab, k=150)
    texts = []
    for _ in range(220):  # similarity of pairs on both sides of 0.8
        w = list(base)
        for at in rng.sample(range(150), rng.randint(0, 9)):
            w[at] = rng.choice(vocab)
        texts.append(" ".join(w))
    texts += [" ".join(rng.choices(vocab, k=120)) for _ in range(40)]
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    got = simhash.similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(root))
    assert 40 < len(set(root)) < 240
