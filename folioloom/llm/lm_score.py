"""Log probabilities of texts under a bigram model by deleted interpolation.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case, then one end.
Every training token counts.  The ``K`` most frequent words (of at most 64 bytes) and the end
have an id of their own; the other words share ``M`` ids by hash.  With v before w

    p(w | v) = l2 c(v w) / c(v)  +  l1 c(w) / N  +  l0 / ids

over ids, times the share that a word has of its id: (c + 0.1) / (c(id) + 0.1 (words of the id + 1)).
The weights l2, l1, l0 belong to a bucket of contexts, the power of two of c(v).  They are learned
by expectation-maximisation on the bigrams of a deleted part of the training rows, under the
counts of the rest; scores then take the counts of both parts.

On the cluster: word counts are combined before their shuffle.  A pass over the texts packs the
bigrams of some million tokens into one block a bucket (every different bigram once, with the
documents that hold it), so what is shuffled are packed blocks and not a row for every token.
Pairs of the ``R`` most frequent ids are only counted: their table of R x R is broadcast and
scored where the text is, so no other bigram is more than one in R of all tokens, and no
bucket is hot.  Words without an id of their own go to buckets in the same blocks and are counted
and scored there; each is less than one in K of all tokens.  Everything broadcast has a bound: K words of 64 bytes, K + M counts, R x R numbers.  The driver
gets the same, and sums of the deleted bigrams by bucket and rounded log probabilities (at most
some 64 x 256 x 256 rows, whatever the corpus).

Defined cases: a null or empty text is one end; rows of null ids are learned from and not held
out; repeated rows get equal scores, one row each; an empty table gives an empty one.  Without any
training row N and V are 0 and scores are those of the uniform part.  Columns besides the id and the text
are not carried on.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import compress, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from folioloom.llm import store

BITS = 17
IDS = 1 << BITS
K = 65_535
M = IDS - K - 1
R = 1024
LONGEST = 64
SPACE = 0.1
TOKENS_A_BLOCK, TOKENS_A_BUCKET, WORDS_HELD = 1_000_000, 3_000_000, 200_000
SCORED, KEPT, DELETED = 0, 1, 2


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, those of one rank together, compressed."""
    codec, out = pa.Codec("zstd", compression_level=1), []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        z = codec.compress(planes, asbytes=True)
        out.append(struct.pack("<cqq", a.dtype.char.encode(), len(a), len(z)) + z)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    codec, out, at = pa.Codec("zstd"), [], 0
    while at < len(data):
        char, n, size = struct.unpack_from("<cqq", data, at)
        at += struct.calcsize("<cqq")
        dtype = np.dtype(char.decode())
        planes = codec.decompress(data[at : at + size], n * dtype.itemsize, asbytes=True)
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T).view(dtype).reshape(n))
        at += size
    return out


@dataclass
class Words:
    """What every task knows of the words; all of bounded size."""

    ids: dict[bytes, int]
    kept: np.ndarray  # counts by id in the kept part
    total: np.ndarray  # counts by id in all training rows
    types: np.ndarray  # different words by id
    n_kept: int
    n_total: int
    n_types: int

    def base(self, count):
        return np.log10((np.asarray(count, np.float64) + SPACE) / (self.n_total + SPACE * (self.n_types + 1)))


def _texts(batch, text: str = "text") -> list[bytes | None]:
    return batch.column(text).cast(pa.binary()).to_pylist()


def _word_counts(rows: DataFrame) -> DataFrame:
    """(word, kept, deleted) over the training rows of ``rows`` (part, text); the empty word is the end."""

    def work(batches):
        held = {KEPT: Counter(), DELETED: Counter()}

        def flush():
            words = list(held[KEPT].keys() | held[DELETED].keys())
            for k in range(0, len(words), 20_000):
                some = words[k : k + 20_000]
                columns = [pa.array(some, pa.binary()).cast(pa.string()), *[pa.array([held[p][w] for w in some], pa.int64()) for p in (KEPT, DELETED)]]
                yield pa.RecordBatch.from_arrays(columns, ["word", "kept", "deleted"])
            for c in held.values():
                c.clear()

        for batch in batches:
            for part, text in zip(batch.column("part").to_pylist(), _texts(batch), strict=True):
                if part != SCORED:
                    held[part].update(tokens(text))
                    held[part][b""] += 1
                    if len(held[KEPT]) + len(held[DELETED]) > WORDS_HELD:
                        yield from flush()
        yield from flush()

    found = rows.select("part", "text").mapInArrow(work, "word string, kept long, deleted long")
    return found.groupBy("word").agg(F.sum("kept").alias("kept"), F.sum("deleted").alias("deleted"))


def _own_id(last) -> Column:
    """True for words with an id of their own, given the last of them (count, word), or None where there is none."""
    if last is None:
        return F.lit(False)
    c = F.col("kept") + F.col("deleted")
    return (F.octet_length("word") <= LONGEST) & (F.col("word") != "") & ((c > last[0]) | (c == last[0]) & (F.col("word") <= last[1]))


def learn_words(counts: DataFrame) -> Words:
    """The bounded part of the word counts."""
    c = F.col("kept") + F.col("deleted")
    sums = counts.agg(F.sum("kept"), F.sum(c), F.count("*")).first()
    kept, total, types = (np.zeros(IDS, np.int64) for _ in range(3))
    first = counts.where((F.octet_length("word") <= LONGEST) & (F.col("word") != "")).orderBy(c.desc(), "word").limit(K)
    top = first.select("word", "kept", c.alias("total")).toArrow().to_pydict()
    n = len(top["word"])
    kept[1 : n + 1], total[1 : n + 1], types[1 : n + 1] = top["kept"], top["total"], 1
    own = _own_id((top["total"][-1], top["word"][-1]) if n else None)
    shared = F.when(F.col("word") == "", F.lit(0)).otherwise(F.crc32(F.col("word").cast("binary")) % M + (K + 1))
    rest = counts.where(~own).groupBy(shared.cast("int").alias("id")).agg(F.sum("kept"), F.sum(c), F.count("*")).toArrow()
    at = np.array(rest.column(0).to_pylist(), np.int64)
    if len(at):
        kept[at], total[at], types[at] = (np.array(rest.column(k).to_pylist(), np.int64) for k in (1, 2, 3))
    return Words({w.encode(): k + 1 for k, w in enumerate(top["word"])}, kept, total, types, sums[0] or 0, sums[1] or 0, sums[2])


def _ids_of(words: list[bytes], ids: dict[bytes, int]) -> np.ndarray:
    """Ids of their own, and -1 for words that share one."""
    return np.fromiter(map(ids.get, words, repeat(-1)), np.int32, len(words))


def _bucket(v: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """A bucket holds cells of one context and 256 neighbouring ids."""
    cell = v * np.int64(IDS >> 8) + (w >> 8)
    return ((cell * np.int64(0x9E3779B1)) >> np.int64(12)) % np.int64(n)


def _first(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))) if len(sorted_keys) else np.zeros(0, np.int64)


def _by_bucket(bucket, key, doc, part):
    """(bucket, different keys, how often kept and deleted parts have each, its documents in a block)."""
    order = np.argsort(bucket << (2 * BITS) | key, kind="stable")
    bucket, key, doc = bucket[order], key[order], doc[order]
    edge = np.append(_first(bucket), len(bucket))
    for b, lo, hi in zip(bucket[edge[:-1]].tolist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        keys, docs = key[lo:hi], doc[lo:hi]
        at = _first(keys)
        role = part[docs]
        parts = [np.add.reduceat(role == p, at, dtype=np.int32) for p in (KEPT, DELETED)]
        yield b, keys[at], parts, pack(np.diff(np.append(at, hi - lo)).astype(np.int32), docs.astype(np.uint16))


@dataclass(frozen=True)
class Buckets:
    """Bigrams have ``n`` buckets from 0, words that share an id the next ``n``, the list of a block's documents the
    next; counts of heavy bigrams have those below 0."""

    n: int
    salts: int
    tokens_a_block: int


def _block_rows(w, words, doc, part, k1, k2, buckets: Buckets):
    """(bucket, payload, documents) of one block; w, doc: one entry a token, w is -1 where ``words`` has the next one; part, k1, k2: one a document.

    Heavy bigrams go to buckets below 0, each of which gets the counts of a bounded number of blocks.
    """
    yield 2 * buckets.n + int(k2[0]) % buckets.n, pack(k1, k2), None
    rare = np.flatnonzero(w < 0)
    numbers: dict[bytes, int] = {}
    at = np.fromiter((numbers.setdefault(x, len(numbers)) for x in words), np.int64, len(words))
    different = list(numbers)
    w[rare] = (K + 1 + np.fromiter(map(zlib.crc32, different), np.int64, len(different)) % M)[at] if len(rare) else 0
    own = buckets.n + (np.fromiter(map(xxh64_intdigest, different), np.uint64, len(different)) % np.uint64(buckets.n)).astype(np.int64)
    for b, keys, parts, docs in _by_bucket(own[at], at, doc[rare], part):
        joined = b"\n".join([different[k] for k in keys.tolist()])
        yield b, pack(np.frombuffer(joined, np.uint8), *parts), docs
    v = np.roll(w, 1)  # the end of a text stands before the next one, and 0 is both
    v[0] = 0
    heavy = (v < R) & (w < R)
    salt = int(k2[0]) % buckets.salts * 16
    for p in (KEPT, DELETED):
        own = heavy & (part[doc] == p)
        keys, n = np.unique(v[own] << BITS | w[own], return_counts=True)
        for s in range(16):
            here = (keys >> BITS) % 16 == s
            if here.any():
                zero = np.zeros(here.sum(), np.int64)
                yield -1 - s - salt, pack(keys[here], *((n[here], zero) if p == KEPT else (zero, n[here]))), None
    v, w, doc = v[~heavy], w[~heavy], doc[~heavy]
    for b, keys, parts, docs in _by_bucket(_bucket(v, w, buckets.n), v << BITS | w, doc, part):
        yield b, pack(np.diff(keys, prepend=0), *parts), docs


def _blocks(rows: DataFrame, words, buckets: Buckets) -> DataFrame:
    """(bucket, block, payload, docs): the bigrams and the rarer words of every text, packed."""
    schema = "bucket int, block long, payload binary, docs binary"
    types = (("bucket", pa.int32()), ("block", pa.int64()), ("payload", pa.binary()), ("docs", pa.binary()))

    def work(batches):
        ids = words.value.ids
        held: list = []
        shared: list[bytes] = []
        size, block = 0, TaskContext.get().partitionId() << 32

        def flush():
            doc = np.repeat(np.arange(len(held)), [len(x[3]) for x in held])
            columns = [np.array([x[k] for x in held], np.int64) for k in range(3)]
            made = _block_rows(np.concatenate([x[3] for x in held]).astype(np.int64), shared, doc, *columns, buckets)
            while some := list(islice(made, 64)):
                rows = [(b, block, payload, docs) for b, payload, docs in some]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(types)], [c for c, _ in types])
            held.clear()
            shared.clear()

        for batch in batches:
            for part, k1, k2, text in zip(*[batch.column(c).to_pylist() for c in ("part", "k1", "k2")], _texts(batch), strict=True):
                found = tokens(text)
                w = np.append(_ids_of(found, ids), np.int32(0))
                shared += compress(found, (w < 0).tolist())
                held.append((part, k1, k2, w))
                size += len(w)
                if size > buckets.tokens_a_block or len(held) == 65_535:
                    yield from flush()
                    size, block = 0, block + 1
        if held:
            yield from flush()

    return rows.select("part", "k1", "k2", "text").mapInArrow(work, schema)


def _grade(p: np.ndarray) -> np.ndarray:
    """0 for no probability, else 1 and up by quarters of a power of two."""
    return np.where(p > 0, 1 + np.minimum(254, np.floor(-4 * np.log2(np.where(p > 0, p, 1)))), 0).astype(np.int64)


def context_bucket(count: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.asarray(count, np.float64) + 1)).astype(np.int64)


def _deleted_sums(key, kept, deleted, words: Words):
    """(code, n, n p2, n p1) of deleted bigrams by context bucket and rounded probabilities."""
    own = deleted > 0
    key, kept, n = key[own], kept[own], deleted[own].astype(np.float64)
    context = words.kept[key >> BITS]
    p2, p1 = kept / np.maximum(context, 1), words.kept[key & (IDS - 1)] / max(words.n_kept, 1)
    code, at = np.unique(context_bucket(context) << 16 | _grade(p2) << 8 | _grade(p1), return_inverse=True)
    return code, np.bincount(at, n), np.bincount(at, n * p2), np.bincount(at, n * p1)


MERGED = "kind string, block long, payload binary, docs binary, code long, n double, p2 double, p1 double"
_TYPES = (("kind", pa.string()), ("block", pa.int64()), ("payload", pa.binary()), ("docs", pa.binary()), ("code", pa.int64()), ("n", pa.float64()), ("p2", pa.float64()), ("p1", pa.float64()))


def _merged(table, bucket: int, words: Words, buckets: Buckets):
    """Rows of MERGED for one bucket: for each block its bigrams (light) or words (words) with their counts in all training
    rows; counts of deleted bigrams (deleted: code, n, p2, p1); counts alone (heavy: code, p2 for kept, p1 for deleted);
    and a block's list of documents as it is (docs)."""
    ids, payloads, docs = (table.column(c).to_pylist() for c in ("block", "payload", "docs"))
    none = (None,) * 4
    if bucket >= 2 * buckets.n:
        return [("docs", i, p, None, *none) for i, p in zip(ids, payloads, strict=True)]
    first, kept, deleted = zip(*[unpack(p) for p in payloads], strict=True)
    ends = np.cumsum([0] + [len(x) for x in kept]).tolist()
    kept, deleted = np.concatenate(kept), np.concatenate(deleted)
    if bucket >= buckets.n:
        numbers: dict[bytes, int] = {}
        at = np.concatenate([np.fromiter((numbers.setdefault(x, len(numbers)) for x in f.tobytes().split(b"\n")), np.int64) for f in first])
        key = np.fromiter(map(zlib.crc32, numbers), np.int64, len(numbers)) % M
    else:
        key, at = np.unique(np.concatenate(first if bucket < 0 else [np.cumsum(f) for f in first]), return_inverse=True)
    kept, deleted = (np.bincount(at, x, len(key)).astype(np.int64) for x in (kept, deleted))
    if bucket < 0:
        return [("heavy", None, None, None, k, None, float(a), float(b)) for k, a, b in zip(key.tolist(), kept.tolist(), deleted.tolist(), strict=True)]
    out, count = [], kept + deleted
    for i, d, lo, hi in zip(ids, docs, ends, ends[1:], strict=False):
        own = key[at[lo:hi]]
        shown = own.astype(np.uint16) if bucket >= buckets.n else np.diff(own, prepend=0)
        out.append(("words" if bucket >= buckets.n else "light", i, pack(shown, count[at[lo:hi]]), d, *none))
    if bucket < buckets.n:
        out += [("deleted", None, None, None, *x) for x in zip(*[a.tolist() for a in _deleted_sums(key, kept, deleted, words)], strict=True)]
    return out


def _merge(blocks: DataFrame, words, buckets: Buckets) -> DataFrame:
    def work(key, table):
        rows = _merged(table, key[0].as_py(), words.value, buckets)
        return pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(_TYPES)})

    return blocks.groupBy("bucket").applyInArrow(work, MERGED)


def mixture_weights(code: np.ndarray, n: np.ndarray, p2: np.ndarray, p1: np.ndarray, rounds: int = 200) -> np.ndarray:
    """weights[bucket] = (l2, l1, l0) by expectation-maximisation; p2 and p1 are means over the n events of a code.

    A bucket without events takes the weights of the next lower one.  Every expected count gets
    a hundredth more, so that no weight is 0, but contexts that were never seen have no l2.
    """
    bucket, out = code >> 16, np.zeros((64, 3))
    last = np.array([0.0, 0.5, 0.5])
    for b in range(64):
        own = bucket == b
        if own.any():
            p = np.stack([p2[own], p1[own], np.full(own.sum(), 1 / IDS)])
            lam = np.array([0.0 if b == 0 else 1.0, 1.0, 1.0])
            lam /= lam.sum()
            for _ in range(rounds):
                mixed = lam[:, None] * p
                expected = (mixed / mixed.sum(0) * n[own]).sum(1) + 0.01 * (lam > 0)
                new = expected / expected.sum()
                done = np.abs(new - lam).max() < 1e-9
                lam = new
                if done:
                    break
            last = lam
        out[b] = last
        if b == 0 and last[0] == 0.0:
            last = np.array([0.5, 0.25, 0.25]) if not own.any() else np.array([0.5, *(lam[1:] / 2)])
    return out


def log_mixture(count: np.ndarray, v: np.ndarray, w: np.ndarray, words: Words, weights: np.ndarray) -> np.ndarray:
    """log10 p(w | v) over ids, where ``count`` is that of the bigram in all training rows."""
    context = words.total[v]
    lam = weights[context_bucket(context)]
    return np.log10(lam[:, 0] * count / np.maximum(context, 1) + lam[:, 1] * words.total[w] / max(words.n_total, 1) + lam[:, 2] / IDS)


PART = "k1 long, k2 long, n_copies long, doc_id long, held_out boolean, n_tokens long, n_known double, base double, score double"
_PARTS = ("k1", "k2", "n_copies", "doc_id", "held_out", "n_tokens", "n_known", "base", "score")


def _bucket_parts(merged: DataFrame, words, weights: np.ndarray) -> DataFrame:
    """(k1, k2, n_known, base, score): what its light bigrams and rarer words add to a document.

    What a bucket tells goes back to its blocks: for light bigrams a sum (of seven digits) by document, for words their counts.
    """
    answer = "block long, kind string, payload binary"

    def work(batches):
        known = words.value
        for batch in batches:
            out = []
            for kind, payload, docs in zip(*[batch.column(c).to_pylist() for c in ("kind", "payload", "docs")], strict=True):
                if kind == "docs":
                    out.append(payload)
                    continue
                (key, count), (sizes, docs) = unpack(payload), unpack(docs)
                if kind == "words":
                    out.append(pack(docs, np.repeat(key, sizes), np.repeat(count, sizes)))
                else:
                    key = np.cumsum(key)
                    logs = log_mixture(count, key >> BITS, key & (IDS - 1), known, weights)
                    here, at = np.unique(docs, return_inverse=True)
                    out.append(pack(here, np.bincount(at, np.repeat(logs, sizes)).astype(np.float32)))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("kind"), pa.array(out, pa.binary())], ["block", "kind", "payload"])

    def gather(table):
        known = words.value
        kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
        k1, k2 = unpack(payloads[kinds.index("docs")])
        sums = np.zeros((3, len(k1)))
        for kind, payload in zip(kinds, payloads, strict=True):
            if kind == "light":
                here, score = unpack(payload)
                sums[2, here] += score
            elif kind == "words":
                docs, key, count = unpack(payload)
                ids = key.astype(np.int64) + (K + 1)
                share = np.log10((count + SPACE) / (known.total[ids] + SPACE * (known.types[ids] + 1)))
                for row, x in zip(sums, ((count > 0).astype(np.float64), known.base(count), share), strict=True):
                    row += np.bincount(docs, x, len(k1))
        return pa.table({c: pa.array(x) for c, x in zip(("k1", "k2", "n_known", "base", "score"), (k1, k2, *sums), strict=True)})

    answers = merged.where("block IS NOT NULL").select("block", "kind", "payload", "docs").mapInArrow(work, answer)
    return answers.groupBy("block").applyInArrow(gather, "k1 long, k2 long, n_known double, base double, score double")


def _text_parts(rows: DataFrame, words, heavy) -> DataFrame:
    """A row a document with what the broadcast tables tell of it."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]

    def work(batches):
        known, logs = words.value, heavy.value
        base = known.base(known.total)
        share = np.log10((known.total + SPACE) / (known.total + SPACE * (known.types + 1)))
        share[0] = 0.0  # the end is all of its id
        seen = (known.total > 0).astype(np.float64)
        for batch in batches:
            out: list[tuple] = []
            for part, doc_id, k1, k2, text in zip(*[batch.column(c).to_pylist() for c in ("part", "doc_id", "k1", "k2")], _texts(batch), strict=True):
                w = np.append(_ids_of(tokens(text), known.ids), np.int32(0))
                v = np.roll(w, 1)
                own, dense = w[w >= 0], (v < R) & (w < R) & (v >= 0) & (w >= 0)
                score = float(logs[v[dense], w[dense]].sum() + share[own].sum())
                out.append((k1, k2, 1, doc_id, part == SCORED, len(w), float(seen[own].sum()), float(base[own].sum()), score))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], list(_PARTS))

    return rows.select("part", "doc_id", "k1", "k2", "text").mapInArrow(work, PART)


def lm_scores(documents: DataFrame, held_out: Column, deleted: Column, tokens_a_block: int = TOKENS_A_BLOCK, tokens_a_bucket: int = TOKENS_A_BUCKET) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of documents (doc_id, text).

    Rows where ``held_out`` is true are scored only; of the others those where ``deleted`` is
    true teach the weights.  Null counts as false in both.
    """
    spark = documents.sparkSession
    broadcast = spark.sparkContext.broadcast
    part = F.when(F.coalesce(held_out, F.lit(False)), SCORED).when(F.coalesce(deleted, F.lit(False)), DELETED).otherwise(KEPT)
    key = F.xxhash64(F.col("doc_id").isNull(), F.coalesce("text", F.lit("")))
    rows = documents.select("doc_id", "text", part.alias("part"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("k1"), key.alias("k2"))
    with store.arrow_rows(spark, 500):
        known = learn_words(store.materialize(_word_counts(rows), "words"))
        words = broadcast(known)
        buckets = Buckets(max(1, -(-known.n_total // tokens_a_bucket)), 1 + known.n_total // (256 * tokens_a_block), tokens_a_block)
    with store.arrow_rows(spark, 32):
        merged = store.materialize(_merge(_blocks(rows, words, buckets), words, buckets), "bigrams")
    weights, heavy = _learned(merged, known)
    names = [x for x in _PARTS if x not in ("k1", "k2")]
    parts = _bucket_parts(merged, words, weights).withColumns({"n_copies": F.lit(0).cast("long"), "doc_id": F.lit(None).cast("long"), "held_out": F.lit(None).cast("boolean"), "n_tokens": F.lit(0).cast("long")})
    both = _text_parts(rows, words, broadcast(heavy)).unionByName(parts)
    sums = both.groupBy("k1", "k2").agg(*[(F.max if x in ("doc_id", "held_out") else F.sum)(x).alias(x) for x in names])
    each = sums.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int"))))
    whole = [F.round(F.col(x) / F.col("n_copies")).cast("long").alias(x) for x in ("n_tokens", "n_known")]
    return each.select("doc_id", "held_out", *whole, F.lit(known.n_total).cast("long").alias("train_tokens"), (F.col("base") / F.col("n_copies")).alias("base_score"), (F.col("score") / F.col("n_copies")).alias("score"))


def _learned(merged: DataFrame, known: Words) -> tuple[np.ndarray, np.ndarray]:
    """Mixture weights, and the log probabilities of all pairs of the R first ids."""
    kept, deleted = np.zeros((R, R), np.int64), np.zeros((R, R), np.int64)
    dense = merged.where("kind = 'heavy'").groupBy("code").agg(F.sum("p2"), F.sum("p1")).toArrow()
    key = dense.column(0).to_numpy()
    for k, table in ((1, kept), (2, deleted)):
        table[key >> BITS, key & (IDS - 1)] = dense.column(k).to_numpy().astype(np.int64)
    v, w = (x.ravel() for x in np.indices((R, R)))
    own = _deleted_sums(v << BITS | w, kept.ravel(), deleted.ravel(), known)
    sums = merged.where("kind = 'deleted'").groupBy("code").agg(F.sum("n"), F.sum("p2"), F.sum("p1")).toArrow()
    code, n, p2, p1 = (np.concatenate([x, sums.column(k).to_numpy().astype(x.dtype)]) for k, x in enumerate(own))
    weights = mixture_weights(code, n, p2 / n, p1 / n)
    return weights, log_mixture((kept + deleted).ravel(), v, w, known, weights).reshape(R, R)


def op11_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return lm_scores(docs, h % 10 == 0, F.floor(h / 10) % 20 == 0)
