"""SimHash links, repeated strings, BPE and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from folioloom.llm import bpe, decontaminate, simhash, suffix_dedup
from folioloom.llm.components import components
from folioloom.llm.suffix_array import suffix_array

RNG = random.Random(7)
PROSE = [" ".join("".join(RNG.choices("abcdeo", k=RNG.randint(2, 8))) for _ in range(RNG.randint(40, 120))) for _ in range(12)]
TEXTS = [
    None, "", " \n", "one", "one two three", *PROSE, PROSE[0], PROSE[0], PROSE[1] + " more", "x" * 900, "ab" * 700, "é" * 300,
    PROSE[2][:250] + " | " + PROSE[3][50:270], "line of common text that many share " * 3 + PROSE[4], "line of common text that many share " * 3 + PROSE[5], "ONE TWO THREE",
]
ROWS = [(k, t) for k, t in enumerate(TEXTS)] + [(5, PROSE[0]), (None, PROSE[6])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "old", 1) for r in ROWS], "doc_id bigint, text string, fp string, lo int")


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(fps, budget):
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(fps))]


def test_simhash(docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    fps = [fingerprint(t) for _, t in ROWS]
    root = linked(fps, 4)
    least = {}
    for (i, _), r in zip(ROWS, root, strict=True):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted((str(i), f - (1 << 64) if f >> 63 else f, str(least[r])) for (i, _), f, r in zip(ROWS, fps, root, strict=True))
    assert sorted((str(r["doc_id"]), r["fp"], str(r["component_id"])) for r in got) == want


@pytest.mark.parametrize("seed", range(4))
def test_trie_links(seed):
    rng = np.random.default_rng(seed)
    centers = rng.integers(1 << 63, size=12, dtype=np.uint64)
    fps = [int(c) for c in centers]
    for c in centers:
        fps += [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(30)]
    fps = np.unique(np.array(fps, np.uint64))
    root = simhash.trie_links(fps, np.array([0]), 4)
    assert root.tolist() == linked(fps.tolist(), 4)


def test_masks_lose_no_pair():
    rng = random.Random(3)
    for n in (10, 10**7, 10**10):
        masks = simhash.block_masks(4, n)
        for _ in range(2000):
            x = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(x & m == 0 for m in masks)


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 160)] + [(200, 200), (None, 3)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 160)} | {200: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("k", [3, 6, 250, 2000])
def test_suffix_array(k):
    rng = np.random.default_rng(k)
    for n in (1, 2, 17, 400):
        t = np.append(rng.integers(1, k, n), 0)
        t[: n // 2] = t[n // 2 : n // 2 + n // 2]  # repeats
        assert suffix_array(t.astype(np.int64), k).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def removed(texts, length):
    count = {}
    data = [(t or "").encode() for t in texts]
    for b in data:
        for i in range(len(b) - length + 1):
            count[b[i : i + length]] = count.get(b[i : i + length], 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i + 1 : i + length + 1] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[1:-1]]) if b else b""
        out.append((len(b), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_repeats(docs, crowd):
    got = suffix_dedup.remove_repeats(docs, crowd=crowd).collect()
    want = sorted((str(i), *w) for (i, _), w in zip(ROWS, removed([t for _, t in ROWS], 200), strict=True))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


def test_no_repeats_in_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0


def test_bpe_is_the_library(spark):
    from tokenizers import Tokenizer

    path = bpe.default_path()
    lib, own = Tokenizer.from_file(path), bpe.tokenizer(path)
    texts = [t or "" for t in TEXTS] + ["it's we'll  <|endoftext|> x<|endoftext|>", "\x1c\x85  tab\t\n\n end ", "１２ ²³ Ⅷ 😀😀 ѣ", "a" * 5000, "\U00012400 \U0001d7d8"]
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)
        assert own.digest(t) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(own.decode(ids).encode()).hexdigest())
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(every), 997):
        t = " x".join(every[k : k + 997])
        assert own.encode(t) == lib.encode(t, add_special_tokens=False).ids
    df = spark.createDataFrame([(None, None), (1, ""), (1, "a b")], "doc_id bigint, text string")
    assert sorted(r["n_tokens"] for r in bpe.round_trip(df, path).collect()) == [0, 0, 2]
    back = bpe.decode(bpe.encode(df, path), path).collect()
    assert [r["decoded"] for r in back] == ["", "", "a b"]
    assert all(r["decodes"] for r in bpe.encode_checked(df, path).collect())


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(row[j], old[j + 1])
    return row[-1]


def test_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(1, 25))] for _ in range(2))
        assert decontaminate.common_subsequence(decontaminate._masks(a), len(a), b) == lcs(a, b)


def test_leaks(spark):
    rng = random.Random(9)
    vocab = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(4000)]
    items = [" ".join(rng.choices(vocab, k=rng.randint(16, 60))) for _ in range(30)]
    docs = [" ".join(rng.choices(vocab, k=rng.randint(60, 400))) for _ in range(200)]
    want = set()
    for k in range(0, 30, 2):
        w = docs[k].split()
        at = rng.randint(0, len(w))
        item = items[k].split()
        if k % 4 == 0:  # a paraphrase: some words in the middle differ
            item[3 : 3 + len(item) // 6] = rng.choices(vocab, k=len(item) // 6)
        docs[k] = " ".join(w[:at] + item + w[at:])
        want.add((k, k))
    rows = [(k, t, "old") for k, t in enumerate(docs)] + [(500, None, ""), (501, "", ""), (502, "short", "")]
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, "")], "item_id bigint, text string")
    got = decontaminate.flag(spark.createDataFrame(rows, "doc_id bigint, text string, leaks string"), bench, cosine=0.6).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], x["item_id"]) for r in got for x in r["leaks"]} == want
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert all(r["leaks"] == [] for r in decontaminate.flag(spark.createDataFrame(rows[:3], "doc_id bigint, text string, x string"), none).collect())
