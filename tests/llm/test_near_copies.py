"""The pipeline's second stage against brute force over five-word shingles."""

import random

import corpus_pipeline as pipeline


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stage_keeps_one_of_similar_texts(spark):
    rng = random.Random(12)
    vocab = ["".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(3000)]
    texts = [None, "", "one", "one two three", "ONE two  three"]
    for k in range(60):
        w = rng.choices(vocab, k=rng.randint(60, 300))
        texts.append(" ".join(w))
        for _ in range(rng.randint(0, 3)):  # near copies, on both sides of the similarity of 0.8
            w = list(w)
            for at in rng.sample(range(len(w)), max(1, int(len(w) * rng.uniform(0.005, 0.04)))):
                w[at] = rng.choice(vocab)
            texts.append(" ".join(w))
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[7]], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = sorted(r["doc_id"] for r in pipeline.simhash_stage(spark, docs, "").collect())
    assert got == sorted(set(root))
    assert len(got) < len(texts) - 30
