"""Removal of repeated byte strings by suffix arrays over shards.

A byte goes when it lies in a ``length``-byte string that also starts anywhere else.  To
deal such strings to shards, each gets the place of the least 16-byte hash inside it (its
anchor), which equal strings share.  Strings of a text with one anchor, and an offset to it
in one block of ``BLOCK``, form a stretch; all of them contain the stretch's core, so a
stretch whose core occurs once in the corpus holds no repeat.  Equal stretches repeat as a
whole.  Different stretches with one core meet in a shard, whose suffix array and permuted
common prefixes find the strings that occur twice.

A core with more than ``crowd`` different stretches (a common line shorter than ``length``)
isn't gathered: its strings are counted by a 128-bit hash instead, partially before the
shuffle.  Stretches carry 64-bit hashes of core and content, which count as equal together.

Defined cases: null texts are empty; texts shorter than ``length`` keep all bytes; a repeated
row is a place of its own, so both rows lose what they share; null ids are rows like others;
an empty table gives an empty result; further columns aren't carried through.
"""

from __future__ import annotations

import gc
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm import store
from folioloom.llm.suffix_array import permuted_lcp, suffix_array

GRAM, BLOCK = 16, 64
SHARD_BYTES = 2_000_000
_C1, _C2, _R, _Q = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def _mix(x: np.ndarray, c: np.uint64) -> np.ndarray:
    x = x * c
    x ^= x >> np.uint64(29)
    x *= _C2
    x ^= x >> np.uint64(32)
    return x


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse, self.up, self.down = base, np.uint64(pow(int(base), -1, 1 << 64)), np.ones(1, np.uint64), np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            n = 1 << int(n).bit_length()
            ones = np.ones(n, np.uint64)
            for name, base in (("up", self.base), ("down", self.inverse)):
                ones[1:] = base
                setattr(self, name, np.multiply.accumulate(ones))


_POWERS = (_Powers(_R), _Powers(_Q))


def words8(b: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as one number."""
    x = b.astype(np.uint64)
    x = x[:-1] | (x[1:] << np.uint64(8))
    x = x[:-2] | (x[2:] << np.uint64(16))
    return x[:-4] | (x[4:] << np.uint64(32))


class Hashes:
    """Hashes of any range of 8 bytes or more, from prefix sums."""

    def __init__(self, w: np.ndarray, which: int):
        self.p = _POWERS[which]
        self.p.reach(len(w) + 1)
        m = _mix(w, _C1 if which else _R)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(m * self.p.up[: len(w)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end - 7] - self.sums[start]) * self.p.down[start]
        return _mix(raw + (end - start).astype(np.uint64), _C1)


def stretches(text: bytes, length: int):
    """(first start, last start, hash of the core, hash of the content) of each stretch of a text."""
    n = len(text)
    b = np.frombuffer(text, np.uint8)
    w = words8(b)
    grams = _mix(w[:-8] ^ (_mix(w[8:], _R) + _C1), _Q)
    place = np.uint64((1 << 31) - 1)  # a string is shorter
    least = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    window, span = length - GRAM + 1, 1
    while 2 * span <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if window > span:
        least = np.minimum(least[: len(least) - (window - span)], least[window - span :])
    starts = np.arange(n - length + 1)
    anchor = (least & place).astype(np.int64)
    block = (anchor - starts) // BLOCK
    cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(block) != 0)) + 1
    lo, hi = np.concatenate([[0], cut]), np.append(cut, len(starts)) - 1
    core = anchor[lo] - BLOCK * block[lo]
    a, c = Hashes(w, 0), Hashes(w, 1)
    return lo, hi, a.of(core, core + length - BLOCK + 1).view(np.int64), c.of(lo, hi + length).view(np.int64)


def _texts(batch, name: str) -> list[bytes | None]:
    return pc.cast(batch.column(name), pa.binary()).to_pylist()


def _stretch_rows(length: int):
    def work(batches):
        for batch in batches:
            ids, marks = batch.column("k").to_numpy(zero_copy_only=False), batch.column("th").to_numpy(zero_copy_only=False)
            found = [(k, *stretches(t, length)) for k, t in enumerate(_texts(batch, "text")) if t is not None and len(t) >= length]
            if found:
                row = np.repeat([x[0] for x in found], [len(x[1]) for x in found])
                lo, hi, core, ctx = (np.concatenate([x[i] for x in found]) for i in range(1, 5))
                yield pa.RecordBatch.from_pydict({"k": ids[row], "th": marks[row], "lo": pa.array(lo, pa.int32()), "hi": pa.array(hi, pa.int32()), "core": core, "ctx": ctx})

    return work


def _pieces(length: int):
    def work(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("core", "k", "th", "lo", "own", "piece")}
            for text, k, th, spans in zip(_texts(batch, "text"), batch.column("k").to_pylist(), batch.column("th").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                for s in spans:
                    for c, v in zip(out, (s["core"], k, th, s["lo"], s["own"], text[s["lo"] : s["hi"] + length]), strict=True):
                        out[c].append(v)
            yield pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, v), t in zip(out.items(), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()), strict=True)})

    return work


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, the starts of its ``length``-byte strings that start anywhere else in the pieces."""
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    t = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8).astype(np.int16) + 2
    t[ends - 1] = 1  # between pieces
    t[-1] = 0
    sa = suffix_array(t, 258)
    cap = length + int(sizes.max()) + 1
    lcp = permuted_lcp(t, sa, cap, begins)
    long = lcp >= length
    twice = long.copy()
    twice[sa[:-1]] |= long[sa[1:]]
    return [np.flatnonzero(twice[b : b + n - length + 1]) for b, n in zip(begins, sizes, strict=True)]


def runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.diff(starts) != 1) + 1
    return starts[np.concatenate([[0], cut])], starts[np.append(cut, len(starts)) - 1]


def _shards(length: int):
    """Suffix arrays over whole cores, as many as fit ``SHARD_BYTES``."""

    def solve(rows: list[tuple]):
        out: list[tuple] = []
        for (_, k, th, lo, own, _), at in zip(rows, repeated_starts([r[5] for r in rows], length), strict=True):
            if own and len(at):
                out += [(k, th, lo + a, lo + z) for a, z in zip(*(x.tolist() for x in runs(at)), strict=True)]
        cols = list(zip(*out, strict=True)) or [()] * 4
        return pa.RecordBatch.from_pydict({c: pa.array(v, t) for c, v, t in zip(("k", "th", "lo", "hi"), cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)})

    def work(batches):
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("core", "k", "th", "lo", "own", "piece")), strict=True):
                if row[0] != last and size >= SHARD_BYTES:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size, last = size + len(row[5]), row[0]
        if held:
            yield solve(held)

    return work


def _window_rows(length: int):
    """Two hashes of each string of the pieces."""

    def work(batches):
        for batch in batches:
            for core, k, th, lo, own, piece in zip(*(batch.column(c).to_pylist() for c in ("core", "k", "th", "lo", "own", "piece")), strict=True):
                w = words8(np.frombuffer(piece, np.uint8))
                at = np.arange(len(piece) - length + 1)
                n = len(at)
                yield pa.RecordBatch.from_pydict({
                    "h1": Hashes(w, 0).of(at, at + length).view(np.int64), "h2": Hashes(w, 1).of(at, at + length).view(np.int64),
                    "k": pa.array([k] * n, pa.int64()), "th": pa.array([th] * n, pa.int64()), "at": pa.array(at + lo, pa.int32()), "own": pa.array([own] * n, pa.bool_()),
                })

    return work


def _keyed(documents: DataFrame, id_col: str, text: str) -> DataFrame:
    """A row is told by its id and a hash of its text; equal rows have equal results."""
    return documents.withColumn("k", F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))).withColumn("th", F.xxhash64(F.col(text)))


def _settle(spark) -> None:
    """Let Spark delete the shuffle files of finished steps now, not when memory runs low."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def repeated_spans(documents: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = 200, crowd: int = 20_000) -> DataFrame:
    """(k, th, lo, hi): inclusive ranges of the starts of repeated strings, by row key."""
    spark = documents.sparkSession
    docs = _keyed(documents.select(id_col, F.col(text).alias("text")), id_col, "text").select("k", "th", "text")
    made = docs.mapInArrow(_stretch_rows(length), "k bigint, th bigint, lo int, hi int, core bigint, ctx bigint")
    path = store.fresh_path(spark, "stretches")
    with store.arrow_rows(spark, 500):  # a text has many stretches
        made.write.parquet(path)
    rows = spark.read.schema(made.schema).parquet(path)
    # written first: the join then deals both sides anew, and a hot core can be split; the aggregate's shuffle is gone by then
    shared = rows.groupBy("core").agg(F.count("*").alias("n"), F.min("ctx").alias("least"), F.max("ctx").alias("most")).where("n > 1")
    shared = store.materialize(shared, "cores")
    _settle(spark)
    several = F.col("least") != F.col("most")
    met = store.materialize(rows.join(shared, "core").select("k", "th", "lo", "hi", "core", "ctx", several.alias("several")), "shared")
    store.drop(spark, path)
    _settle(spark)
    # one witness of each different stretch; the others are its equals
    kinds = met.where("several").groupBy("core", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("k", "th", "lo", "hi")).alias("w"))
    kinds = store.materialize(kinds.select("core", "ctx", "n", "w.*"), "kinds")
    equal = met.where("several").join(kinds.where("n > 1").select("core", "ctx"), ["core", "ctx"], "left_semi")
    whole = met.where("NOT several").unionByName(equal).select("k", "th", "lo", "hi")
    crowds = kinds.groupBy("core").agg(F.count("*").alias("kinds")).where(F.col("kinds") > crowd).select("core")
    by_doc = kinds.groupBy("k", "th").agg(F.collect_list(F.struct("core", "lo", "hi", (F.col("n") == 1).alias("own"))).alias("spans"))
    cut = docs.dropna(subset=["text"]).join(by_doc, ["k", "th"]).mapInArrow(_pieces(length), "core bigint, k bigint, th bigint, lo int, own boolean, piece binary")
    crowded = [r["core"] for r in crowds.limit(1).collect()]
    if crowded:
        cut = store.materialize(cut, "pieces")
        few, many = cut.join(crowds, "core", "left_anti"), cut.join(crowds, "core", "left_semi")
    else:
        few, many = cut, None
    solved = few.repartition("core").sortWithinPartitions("core", "k", "th", "lo").mapInArrow(_shards(length), "k bigint, th bigint, lo int, hi int")
    found = store.materialize(solved, "repeats")
    if many is not None:
        each = store.materialize(many.mapInArrow(_window_rows(length), "h1 bigint, h2 bigint, k bigint, th bigint, at int, own boolean"), "windows")
        twice = each.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
        found = found.unionByName(each.where("own").join(twice, ["h1", "h2"], "left_semi").select("k", "th", F.col("at").alias("lo"), F.col("at").alias("hi")))
    _settle(spark)
    return whole.unionByName(found)


def _cut_rows(fields, length: int, with_text: bool):
    def work(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for text, spans in zip(_texts(batch, "text"), batch.column("spans").to_pylist(), strict=True):
                text = text or b""
                rest, removed, n = [], 0, 0
                at = upto = 0  # kept so far; end of the open removed run
                for lo, hi in sorted((s["lo"], s["hi"] + length) for s in spans or ()):
                    if lo > upto or not n:
                        rest.append(text[upto:lo])
                        n += 1
                        removed += hi - lo
                        upto = hi
                    elif hi > upto:
                        removed += hi - upto
                        upto = hi
                rest.append(text[upto:])
                kept = b"".join(rest)
                for c, v in zip(out, (len(text), removed, n, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    out[c].append(v)
            made = {c: pa.array(v, t) for (c, v), t in zip(out.items(), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)}
            if not with_text:
                made.pop("kept")
            yield pa.RecordBatch.from_pydict({f: batch.column(f) for f in fields} | made)

    return work


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = 200, crowd: int = 20_000, with_text: bool = True) -> DataFrame:
    """``id_col`` plus n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes (``kept``)."""
    spans = repeated_spans(documents, id_col, text, length, crowd)
    by_doc = spans.groupBy("k", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    docs = _keyed(documents.select(id_col, F.col(text).alias("text")), id_col, "text")
    joined = docs.join(by_doc, ["k", "th"], "left").select(id_col, "text", "spans")
    kind = documents.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text
    return joined.mapInArrow(_cut_rows([id_col], length, with_text), schema)


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, with_text=False)
