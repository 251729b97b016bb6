"""Chains of any length are one chain: marginals against a plain forward-backward in logs."""

import numpy as np
import pytest

from folioloom.llm import toxicity


def plain(e, trans):
    n = len(e)
    s = np.stack([np.zeros(n), np.clip(e, -30, 30)], axis=1)
    f, b = np.zeros((n, 2)), np.zeros((n, 2))
    f[0] = s[0]
    for k in range(1, n):
        f[k] = s[k] + np.logaddexp(f[k - 1, 0] + trans[0], f[k - 1, 1] + trans[1])
    for k in range(n - 2, -1, -1):
        v = trans + (s[k + 1] + b[k + 1])[None]
        b[k] = np.logaddexp(v[:, 0], v[:, 1])
    p = f + b
    total = np.logaddexp(p[:, 0], p[:, 1])
    pairs = np.zeros((2, 2))
    for k in range(1, n):
        v = f[k - 1][:, None] + trans + (s[k] + b[k])[None]
        pairs += np.exp(v - total[0])
    return np.exp(p[:, 1] - total), pairs, total[0]


@pytest.mark.parametrize("seed", range(3))
def test_marginals_of_long_chains(seed):
    rng = np.random.default_rng(seed)
    trans = rng.normal(0, 1.5, (2, 2))
    lengths = np.array([1, 99, 100, 101, 200, 201, 350, 5, 1234])
    starts = np.cumsum(lengths) - lengths
    e = rng.normal(-1, 2, lengths.sum())
    post, z, pairs = toxicity.marginals(e, starts, lengths, trans, pairs=True)
    want, sums, total = [], np.zeros((2, 2)), 0.0
    for s, n in zip(starts, lengths, strict=True):
        p, w, t = plain(e[s : s + n], trans)
        want.append(p)
        sums += w
        total += t + np.log(0.5)
    assert np.allclose(post, np.concatenate(want), atol=1e-9)
    assert np.allclose(pairs, sums) and np.isclose(z, total)


def test_a_long_sentence_is_one_chain():
    starts, lengths = toxicity.sequences(np.zeros(400, bool), np.array([300, 0, 100]))
    assert starts.tolist() == [0, 300] and lengths.tolist() == [300, 100]


def test_labels_that_clash_are_toxic(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, prior: seen.update(zip(texts, labels, strict=True)))
    docs = spark.createDataFrame([(1, "a"), (3, "b"), (4, "b"), (5, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (3, 0), (4, 1), (5, 0)], "doc_id long, toxic int")
    toxicity.fit_from(docs, labels.where(f"NOT ({toxicity.HELD_OUT})"))
    held = {r["doc_id"] for r in docs.where(toxicity.HELD_OUT).collect()}
    want = {t: y for i, t, y in ((1, "a", 1), (5, "c", 0)) if i not in held}
    assert {k: v for k, v in seen.items() if k != "b"} == want
