"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed terms over all passages of the corpus.
2. One more pass sketches A = X'X for the TF-IDF matrix X of all passages: each task adds
   X'(X W) for a random matrix W of fixed size, and the sums meet part by part.  The sketch
   (terms x ``rank`` numbers, whatever the corpus) gives the leading singular vectors of X.
3. Every document's windows, of each item's own length, are compared with the items by cosine
   in the latent space; candidates are then checked by the longest common subsequence of
   words, and where that is short of a copy, by the item's answer: its last words.
4. Items that this leaves are checked wherever three of their words stand in a row, which
   every copy of over 8 words has unless words are put in between: with a quarter of the
   words changed, some three in a row are not.

Items are searched in blocks of ``ITEMS_AT_ONCE``, so a benchmark of any size is held in part.

Defined cases: null and empty texts hold nothing; items without words are never found; an
empty benchmark or corpus gives no leaks; repeated rows and further columns pass through; ids of
items may be of any type.  Terms in over 1 % of all passages weigh nothing in the latent space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from folioloom.llm.suffix_dedup import _Powers

TERMS, RANK, KEPT_RANK, PASSAGE, STEP = 1 << 14, 40, 32, 64, 8
PART = 1 << 13
#: Sums of parts meet in two steps, the first in so many places, so that no task reads every task's part.
SALTS = 64
ITEMS_AT_ONCE = 5000
#: Bounds of a task's memory: texts and bytes of texts at once, and windows that meet the items at once.
DOCS_AT_ONCE, BYTES_AT_ONCE, WINDOWS_AT_ONCE = 500, 4_000_000, 8192


#: Lower case of each byte that words are made of (ASCII letters and digits, all of UTF-8 beyond), else 0.
_WORD = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 0 for c in range(256)], np.uint8)
_BYTE = np.random.default_rng(3).integers(1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
_POWERS = _Powers(np.uint64(0x9E6C63D0876A9A35))


def words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(31-bit hashes of all words, words in each text), as array operations over the bytes."""
    lengths = np.array([len(t or b"") + 1 for t in texts], np.int64)
    b = _WORD[np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)]
    is_word = b > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], is_word]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    _POWERS.reach(len(b))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * _POWERS.up[: len(b)])])
    h = (sums[ends] - sums[starts]) * _POWERS.down[starts]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    owner = np.searchsorted(np.cumsum(lengths), starts, "right")
    return (h >> np.uint64(33)).astype(np.int32), np.bincount(owner, minlength=len(texts)).astype(np.int64)


def cuts(n: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks of ``step`` words that don't cross texts, and each block's text."""
    blocks = -(-n // step)
    owner = np.repeat(np.arange(len(n)), blocks)
    first = np.cumsum(blocks) - blocks
    begins = np.cumsum(n) - n
    return begins[owner] + step * (np.arange(len(owner)) - first[owner]), owner


def _bytes(batch, name: str) -> list[bytes | None]:
    return pc.cast(batch.column(name), pa.binary()).to_pylist()


def _slices(batches, name: str = "text"):
    """Parts of the batches of few texts and few bytes; a very long text is a part of its own."""
    for batch in batches:
        size = pc.fill_null(pc.cast(pc.binary_length(batch.column(name)), pa.int64()), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BYTES_AT_ONCE, "right"))
            upto = min(max(upto, at + 1), at + DOCS_AT_ONCE)
            yield batch.slice(at, upto - at)
            at = upto


def _parts(values: np.ndarray):
    flat = np.ascontiguousarray(values, np.float64).ravel()
    for k in range(0, len(flat), PART):
        yield pa.RecordBatch.from_pydict({"part": pa.array([k // PART], pa.int32()), "sums": pa.array([flat[k : k + PART].tobytes()], pa.binary())})


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """Sum of every task's vector of ``size`` numbers: added up part by part, then fetched once."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                sums[k] = sums[k] + np.frombuffer(raw) if k in sums else np.frombuffer(raw).copy()
        for k, v in sums.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "sums": pa.array([v.tobytes()], pa.binary())})

    out = np.zeros(size)
    kind = "part int, sums binary"
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))).repartition("part", "salt").select("part", "sums").mapInArrow(add, kind)
    for row in salted.repartition("part").mapInArrow(add, kind).collect():
        v = np.frombuffer(bytes(row["sums"]))
        out[row["part"] * PART : row["part"] * PART + len(v)] += v
    return out


def passage_frequencies(texts: DataFrame) -> np.ndarray:
    """Passages that hold each hashed term, and at the end the number of passages."""

    def work(batches):
        df = np.zeros(TERMS + 1)
        for batch in _slices(batches):
            ids, n = words(_bytes(batch, "text"))
            if len(ids):
                starts, _ = cuts(n, PASSAGE)
                passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
                pair = np.sort((passage * TERMS + ids % TERMS).astype(np.int32 if len(starts) < 1 << 17 else np.int64))
                pair = pair[np.append(True, pair[1:] != pair[:-1])]
                df[:TERMS] += np.bincount(pair % TERMS, minlength=TERMS)
                df[TERMS] += len(starts)
        yield from _parts(df)

    return summed(texts.mapInArrow(work, "part int, sums binary"), TERMS + 1)


def weights(counts: np.ndarray, common: float = 0.01, least: float = 30) -> np.ndarray:
    """Inverse frequencies; terms in over ``common`` of all passages (``least`` of them, if fewer) weigh nothing."""
    share = (1 + counts[:TERMS]) / (1 + counts[TERMS])
    return np.where((share <= common) | (counts[:TERMS] <= least), -np.log(np.minimum(share, 0.5)), 0.0)


def block_sums(values: np.ndarray, term: np.ndarray, starts: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Sum of the rows of ``values`` over each block's terms; terms that weigh nothing are left out."""
    at = np.flatnonzero(live[term])
    out = np.zeros((len(starts), values.shape[1]), np.float32)
    if len(at):
        block = np.searchsorted(starts, at, "right") - 1
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        out[block[first]] = np.add.reduceat(values[term[at]], first, axis=0)
    return out


def random_matrix() -> np.ndarray:
    return np.random.default_rng(20).standard_normal((TERMS, RANK))


def sketch(texts: DataFrame, idf: np.ndarray) -> np.ndarray:
    """X'X W over all passages."""

    def work(batches):
        out = np.zeros((TERMS, RANK))
        w, live = (idf[:, None] * random_matrix()).astype(np.float32), idf > 0
        for batch in _slices(batches):
            ids, n = words(_bytes(batch, "text"))
            if not len(ids):
                continue
            term = (ids % TERMS).astype(np.uint16)
            starts, _ = cuts(n, PASSAGE)
            y = block_sums(w, term, starts, live)
            passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
            passage, term = passage[live[term]], term[live[term]]
            if not len(term):
                continue
            order = np.argsort(term, kind="stable")
            t = term[order]
            first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
            out[t[first]] += np.add.reduceat(y[passage[order]], first, axis=0)
        yield from _parts(out * idf[:, None])

    return summed(texts.mapInArrow(work, "part int, sums binary"), TERMS * RANK).reshape(TERMS, RANK)


def singular_vectors(y: np.ndarray) -> np.ndarray:
    """Right singular vectors of X over their singular values, from the sketch (Nystroem's form)."""
    w = random_matrix()
    shift = 1e-7 * max(np.linalg.norm(y), 1e-12)
    y = y + shift * w
    b = w.T @ y
    try:
        c = np.linalg.cholesky((b + b.T) / 2)
    except np.linalg.LinAlgError:  # fewer passages than the rank
        values, vectors = np.linalg.eigh((b + b.T) / 2)
        c = vectors * np.sqrt(np.maximum(values, shift))
    u, s, _ = np.linalg.svd(np.linalg.solve(c, y.T).T, full_matrices=False)
    keep = s[:KEPT_RANK] > 1e-6 * s[0]
    return u[:, :KEPT_RANK][:, keep] / s[:KEPT_RANK][keep]


def common_subsequence(item: dict[int, int], m: int, window: list[int]) -> int:
    """Length of the longest common subsequence; ``item`` has a bit mask of places for each word."""
    full = (1 << m) - 1
    v = full
    for c in window:
        u = v & item.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return m - v.bit_count()


def _masks(ids: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, c in enumerate(ids):
        out[c] = out.get(c, 0) | 1 << k
    return out


#: Bits of a triple by which most of a text's triples are told from those of items.
TRIPLE_BITS = 22


def triples(ids: np.ndarray) -> np.ndarray:
    """A hash of each three words in a row, of all words where they are fewer."""
    x = ids.astype(np.uint64)
    if len(x) < 3:
        return np.array([hash(tuple(ids.tolist())) & ((1 << 63) - 1)], np.uint64)
    h = (x[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (x[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (x[2:] * np.uint64(0xD6E8FEB86659FD93))
    return h >> np.uint64(1)


class Items:
    """Items by window length, with latent vectors and what the checks need."""

    def __init__(self, rows: list[tuple], table: np.ndarray, copy: float, paraphrase: float, answer: int):
        ids, n = words([t.encode() for _, t in rows])
        ends = np.cumsum(n)
        self.copy, self.paraphrase = copy, paraphrase
        self.live = np.abs(table).sum(axis=1) > 0
        self.keys, self.words, self.answers = [], [], []
        self.triples: dict[int, list[int]] = {}  # three words in a row -> items
        by: dict[int, list[int]] = {}
        vectors = []
        for (key, _), end, m in zip(rows, ends.tolist(), n.tolist(), strict=True):
            if not m:
                continue
            own = ids[end - m : end].tolist()
            if self.live[np.array(own) % TERMS].any():  # else its vector is zero, and no window is near it
                by.setdefault(max(1, round(m / STEP)), []).append(len(self.keys))
            for h in np.unique(triples(np.array(own, np.int32))).tolist():
                self.triples.setdefault(h, []).append(len(self.keys))
            self.keys.append(key)
            self.words.append((_masks(own), m))
            last = own[-answer:]
            self.answers.append((_masks(last), len(last)))
            vectors.append(table[np.array(own) % TERMS].sum(axis=0))
        self.maybe = np.zeros(1 << TRIPLE_BITS, bool)
        self.maybe[np.array([h >> (63 - TRIPLE_BITS) for h in self.triples], np.int64)] = True
        self.by_size = {}
        for size, which in by.items():
            v = np.array([vectors[k] for k in which])
            self.by_size[size] = (np.array(which), (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32))

    def check(self, k: int, window: list[int]) -> float:
        """Share of the item in the window where it is a copy or a paraphrase, else 0."""
        masks, m = self.words[k]
        window = [c for c in window if c in masks]  # the others can't be in a common subsequence
        if len(window) < self.paraphrase * m:
            return 0.0
        share = common_subsequence(masks, m, window) / m
        if share >= self.copy:
            return share
        if share >= self.paraphrase:
            masks, a = self.answers[k]
            if common_subsequence(masks, a, window) >= 0.85 * a:
                return share
        return 0.0


def flag(documents: DataFrame, benchmark: DataFrame, text: str = "text", cosine: float = 0.75, copy: float = 0.75, paraphrase: float = 0.6, answer: int = 8) -> DataFrame:
    """documents plus ``leaks``: an array of (item_id, share, cosine), one of each item found; ids keep their type.

    The cosine is null where only three words in a row led to the item.
    """
    df = documents.drop("leaks")
    texts = df.select(F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    counts = passage_frequencies(texts)
    idf = weights(counts)
    table = (idf[:, None] * singular_vectors(sketch(texts, idf))).astype(np.float32) if counts[TERMS] else np.zeros((TERMS, 1), np.float32)
    items = benchmark.select("item_id", F.col("text").alias("item_text")).dropna(subset=["item_text"]).dropDuplicates(["item_id", "item_text"])
    total = items.count()
    blocks = max(1, -(-total // ITEMS_AT_ONCE))
    kept = df.schema.fields
    id_type = benchmark.schema["item_id"].dataType
    kind = pa.list_(pa.struct([("item_id", to_arrow_type(id_type)), ("share", pa.float64()), ("cosine", pa.float64())]))

    def search(rows):
        def work(batches):
            known = Items(rows, table, copy, paraphrase, answer)
            for batch in _slices(batches, text):
                ids, n = words(_bytes(batch, text))
                found: list[dict] = [{} for _ in range(batch.num_rows)]
                if len(ids) and known.keys:
                    _find(ids, n, table, known, found, cosine)
                    _find_triples(ids, n, known, found)
                had = batch.column("leaks").to_pylist() if "leaks" in batch.schema.names else [None] * len(found)
                leaks = [[*(old or []), *({"item_id": known.keys[k], "share": s, "cosine": c} for k, (s, c) in sorted(f.items()))] for old, f in zip(had, found, strict=True)]
                yield pa.RecordBatch.from_pydict({f.name: batch.column(f.name) for f in kept} | {"leaks": pa.array(leaks, kind)})

        return work

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept) + "leaks array<struct<item_id:" + id_type.simpleString() + ",share:double,cosine:double>>"
    out = df
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(blocks)) == b)
        rows = [(r["item_id"], r["item_text"]) for r in part.collect()]
        out = out.mapInArrow(search(rows), schema)
    return out


def _find(ids: np.ndarray, n: np.ndarray, table: np.ndarray, known: Items, found: list[dict], cosine: float) -> None:
    starts, owner = cuts(n, STEP)
    if not known.by_size:
        return
    blocks = block_sums(table, (ids % TERMS).astype(np.uint16), starts, known.live)
    sums = np.concatenate([np.zeros((1, blocks.shape[1])), np.cumsum(blocks, axis=0, dtype=np.float64)])
    last = np.append(np.flatnonzero(np.diff(owner)) + 1, len(owner))  # end of each text's blocks
    text_end = last[np.searchsorted(last, np.arange(len(owner)), "right")]
    word_end = np.append(starts[1:], len(ids))
    for size, (which, vectors) in known.by_size.items():
        end = np.minimum(np.arange(len(owner)) + size, text_end)
        for first in range(0, len(owner), WINDOWS_AT_ONCE):
            some = slice(first, min(first + WINDOWS_AT_ONCE, len(owner)))
            w = (sums[end[some]] - sums[some]).astype(np.float32)
            w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)
            near = w @ vectors.T
            at, k = np.nonzero(near >= cosine)
            order = np.argsort(-near[at, k], kind="stable")
            for b, j in zip((at[order] + first).tolist(), k[order].tolist()):
                item, text = int(which[j]), int(owner[b])
                if item in found[text]:
                    continue
                lo = starts[b - 1] if b and owner[b - 1] == text else starts[b]
                e = min(int(end[b]) + 1, int(text_end[b])) - 1
                share = known.check(item, ids[lo : word_end[e]].tolist())
                if share:
                    found[text][item] = (share, float(near[b - first, j]))


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """One row for each document and item it leaks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    flagged = flag(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return flagged.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.item_id", F.round("leak.share", 6).alias("share"))


def _find_triples(ids: np.ndarray, n: np.ndarray, known: Items, found: list[dict]) -> None:
    """Items checked wherever three of their words stand in a row."""
    ends = np.cumsum(n)
    at, h = np.empty(0, np.int64), np.empty(0, np.uint64)
    if len(ids) >= 3:
        h = triples(ids)
        at = np.flatnonzero(known.maybe[h >> np.uint64(63 - TRIPLE_BITS)])
        owner = np.searchsorted(ends, at, "right")
        at = at[at + 3 <= ends[owner]]
        h = h[at]
    short = np.flatnonzero((n > 0) & (n < 3))
    hits = [*zip(at.tolist(), h.tolist(), strict=True), *((int(ends[k] - n[k]), int(triples(ids[ends[k] - n[k] : ends[k]])[0])) for k in short)]
    for p, x in hits:
        for k in known.triples.get(x, ()):
            text, size = int(np.searchsorted(ends, p, "right")), known.words[k][1]
            if k in found[text]:
                continue
            lo, hi = max(int(ends[text] - n[text]), p - size), min(int(ends[text]), p + size + 2)
            if share := known.check(k, ids[lo:hi].tolist()):
                found[text][k] = (share, None)
