"""Scores against a plain model of the same definition, with weights learned event by event."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioloom.llm import lm_score as lm

RNG = random.Random(3)
VOCABULARY = ["W" + str(k) for k in range(2500)]
LONG = ["long" * 17 + str(k) for k in range(12)]


def prose():
    out, k = [], RNG.randint(0, 2499)
    for _ in range(RNG.randint(0, 90)):
        k = (k * 7 + RNG.choice([1, 2, 3])) % 2500 if RNG.random() < 0.7 else int(2500 * RNG.random() ** 3)
        out.append(RNG.choice(LONG) if RNG.random() < 0.03 else VOCABULARY[k])
    return " ".join(out)


ROWS = [(k, prose()) for k in range(500)] + [(500, None), (501, ""), (502, "\t\n "), (503, "never-seen-" + "x" * 70), (7, None), (None, "W1 W2"), (11, "É é W1\x85W2")]
ROWS += [ROWS[2], ROWS[2]]


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [""]


def crc(k):
    return zlib.crc32(str(k).encode())


def held_out(k):
    return k is not None and crc(k) % 10 == 0


def deleted(k):
    return k is not None and crc(k) // 10 % 5 == 0


def brute(rows):
    train = [(k, tokens(t)) for k, t in rows if not held_out(k)]
    count = Counter(w for _, ts in train for w in ts)
    kept = [ts for k, ts in train if not deleted(k)]
    n, v = sum(count.values()), len(count)
    ranked = sorted((w for w in count if w and len(w.encode()) <= 64), key=lambda w: (-count[w], w.encode()))[: lm.K]
    own = {w: k + 1 for k, w in enumerate(ranked)} | {"": 0}

    def id_of(w):
        return own[w] if w in own else lm.K + 1 + zlib.crc32(w.encode()) % lm.M

    def pairs(ts):
        ids = [0, *map(id_of, ts)]
        return list(zip(ids, ids[1:]))

    def counts(many):
        return Counter(id_of(w) for ts in many for w in ts), Counter(p for ts in many for p in pairs(ts))

    k1, k2 = counts(kept)
    a1, a2 = counts([ts for _, ts in train])
    kinds = Counter(map(id_of, count))
    lam = {b: ([0, 0.5, 0.5] if b == 0 else [1 / 3] * 3) for b in range(64)}
    events = {}
    for k, ts in train:
        if deleted(k):
            for p in pairs(ts):
                c = k1[p[0]]
                events.setdefault(int(math.log2(c + 1)), []).append((k2[p] / max(c, 1), k1[p[1]] / sum(k1.values()), 1 / lm.IDS))
    for b, e in events.items():
        e, x = np.array(e).T, np.array(lam[b])
        for _ in range(300):
            m = x[:, None] * e
            x = (m / m.sum(0)).sum(1) + 0.01 * (x > 0)
            x /= x.sum()
        lam[b] = x
    out = []
    for k, t in rows:
        ts = tokens(t)
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts)
        score = 0.0
        for (x, y), w in zip(pairs(ts), ts, strict=True):
            b = int(math.log2(a1[x] + 1))
            while b and b not in events:
                b -= 1
            la = lam[b]
            score += math.log10(la[0] * a2[x, y] / max(a1[x], 1) + la[1] * a1[y] / n + la[2] / lm.IDS)
            score += 0.0 if w == "" else math.log10((count[w] + 0.1) / (a1[y] + 0.1 * (kinds[y] + 1)))
        out.append((str(k), held_out(k), len(ts), sum(count[w] > 0 for w in ts), n, base, score))
    return sorted(out)


@pytest.mark.parametrize("sizes", [(lm.TOKENS_A_BLOCK, lm.TOKENS_A_BUCKET), (700, 3000)])
def test_against_a_plain_model(spark, sizes):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    got = sorted(tuple([str(r.doc_id), *r[1:]]) for r in lm.lm_scores(docs, h % 10 == 0, F.floor(h / 10) % 5 == 0, *sizes).collect())
    want = brute(ROWS)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert np.allclose([g[6] for g in got], [w[6] for w in want], rtol=5e-3)
    out = [g for g in got if g[1]]
    assert sum(g[6] for g in out) > sum(g[5] for g in out)


def test_no_rows_and_nothing_to_learn_from(spark):
    docs = spark.createDataFrame(ROWS[:4], "doc_id bigint, text string")
    assert lm.lm_scores(docs.limit(0), F.lit(False), F.lit(False)).count() == 0
    got = lm.lm_scores(docs, F.lit(True), F.lit(False)).collect()
    assert len(got) == 4 and all(r.train_tokens == r.n_known == 0 and math.isfinite(r.score) for r in got)


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(4)
    pair = rng.integers(0, 5, (6, 6))
    total = np.zeros(lm.IDS, np.int64)
    total[:6] = pair.sum(1)
    words = lm.Words({}, total, total, (total > 0).astype(np.int64), int(total.sum()), int(total.sum()), 6)
    weights = np.tile([0.5, 0.3, 0.2], (64, 1))
    for v in range(6):
        count = np.zeros(lm.IDS)
        count[:6] = pair[v]
        p = 10 ** lm.log_mixture(count, np.full(lm.IDS, v), np.arange(lm.IDS), words, weights)
        assert math.isclose(p.sum(), 1.0, rel_tol=1e-9)


def test_packing_is_exact():
    arrays = [np.arange(5, dtype=np.int64) * -(10**12), np.zeros(0, np.uint16), np.array([1.5, -2.0]), np.array([7], np.uint8)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, lm.unpack(lm.pack(*arrays)), strict=True))
