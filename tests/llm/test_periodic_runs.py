"""Runs against the definition, lag by lag and word by word."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from folioloom.llm import periodic_runs as pr

RNG = random.Random(11)


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def brute(w):
    found = []
    for q in range(1, len(w) // 4 + 1):
        s = 0
        while s + q < len(w):
            e = s
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            if e > s and e + q - s >= max(6, 4 * q) and smallest_period(w[s : e + q]) == q:
                found.append((s, e + q - s, q))
            s = e + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def text_of(kind):
    if kind == "ab":
        return [RNG.choice("ab") for _ in range(RNG.randint(0, 150))]
    if kind == "few":
        return [RNG.choice("aaaabc") for _ in range(RNG.randint(0, 200))]
    block = [RNG.choice("abcdef") for _ in range(RNG.randint(1, 30))]
    noise = [RNG.choice("abcdef") for _ in range(RNG.randint(0, 40))]
    out = noise + block * RNG.randint(2, 7) + block[: RNG.randint(0, len(block))] + noise
    if RNG.random() < 0.5:
        out += out[: len(out) // 2] * 3
    return out


TEXTS = [text_of(k) for k in ("ab", "few", "block") for _ in range(60)] + [["a"] * k for k in range(9)] + [list("aab") * 9 + list("aab" * 2) * 3, list("ab" * 40) + ["c"] + list("ab" * 40)]


@pytest.mark.parametrize("heavy_from", [None, 0.0, 5.0])
def test_runs_against_the_definition(heavy_from):
    for w in TEXTS:
        assert pr.find_runs(pr.numbered(w), heavy_from) == brute(w), w


def test_large_lags_in_steps(monkeypatch):
    monkeypatch.setattr(pr, "SHORT", 0)
    for w in TEXTS:
        assert pr.find_runs(pr.numbered(w)) == brute(w), w


def test_counts_are_exact():
    for w in TEXTS:
        ids = pr.numbered(w)
        for heavy_from in (0.0, 3.0, 1e9):
            got = pr.lag_counts(ids, heavy_from)
            assert got.tolist() == [0] + [int((ids[q:] == ids[:-q]).sum()) for q in range(1, len(w) // 4 + 1)] if len(w) >= 4 else not got.any()


def test_long_texts_in_time():
    begun = time.process_time()
    assert pr.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    ab = np.random.default_rng(1).integers(0, 2, 60_000)
    assert all(m >= max(6, 4 * q) for _, m, q in pr.find_runs(ab))
    block = np.random.default_rng(2).integers(0, 9000, 20_000)
    assert pr.find_runs(np.tile(block, 5)) == [(0, 100_000, 20_000)]
    assert time.process_time() - begun < 60


def test_table(spark):
    rows = [(k, " \n".join(w)) for k, w in enumerate(TEXTS)] + [(None, "a " * 20), (5, None), (5, None), (7, "\t\n"), (10**12, "é " * 7 + "x")]
    docs = spark.createDataFrame([(*r, 1, "old") for r in rows], "doc_id bigint, text string, __x int, n_runs string")
    got = pr.digests(docs).collect()
    want = []
    for k, t in rows:
        w = (t or "").encode().split()
        h = zlib.crc32(str(k).encode()) if k is not None else 1
        if w and h % 10 == 0:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = brute(w)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        told = "".join("%d,%d,%d\n" % r for r in runs)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((k, len(runs), *top, top[0] is not None and 1000 * top[1] // top[2] or None, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)) for r in got)
    assert {r["__x"] for r in got} == {1}
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0] is not None) > 5


def test_whole_output_and_no_rows(spark):
    docs = spark.createDataFrame([(3, "x " + "a b " * 5 + "y")], "doc_id bigint, text string")
    row = pr.periodic_runs(docs).first()
    assert (row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (12, [(1, 10, 2)], "x a b y")
    assert pr.periodic_runs(docs.limit(0)).count() == 0
