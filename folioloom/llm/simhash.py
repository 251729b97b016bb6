"""SimHash near-duplicates: fingerprints, then a binary trie joined with itself.

A fingerprint has a bit set where more than half of the shingle hashes have it.  Two texts
link when their fingerprints differ in at most ``budget`` bits.  Equal fingerprints collapse
first, so copies of any number are one node.  The 64 bits are cut into ``budget + 1`` or more
blocks; two fingerprints within the budget agree on ``blocks - budget`` of them at least, and
each such choice of blocks is a bucket.  In a bucket the sorted fingerprints are a binary
trie: pairs of nodes descend together, count the bits that differ, and stop when the budget
is exceeded.  A bucket gives the spanning links of its components, never all its pairs.

Defined cases: null and blank texts have no words and get fingerprint zero, which links like
any other; a text with fewer words than a shingle is one shingle; repeated rows and ids stay
rows of their own; null ids never become a component's name unless all its ids are null; an
empty table gives an empty result; further columns are kept where their names are free.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm import store
from folioloom.llm.components import components

SEED = 42
#: Shingle hashes counted at once, and node pairs held at once: bounds of a task's memory.
COUNT_AT_ONCE = 250_000
PAIRS_AT_ONCE = 400_000
ROWS_AT_ONCE = 200_000


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, n, digest = b" ".join(words), len(words), xxhash.xxh64_intdigest
    if n <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - width + 1].tolist()
    return np.fromiter((digest(joined[i:j], SEED) for i, j in zip(starts, ends[width - 1 :].tolist())), np.uint64, n - width + 1)


def _set_bits(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


_WEIGHTS = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))


def fingerprints(texts: list[bytes | None], width: int) -> np.ndarray:
    """One fingerprint a text, as int64 with the same bits."""
    return fingerprints_of((shingle_hashes(t, width) for t in texts), len(texts))


def fingerprints_of(hashes: Iterable[np.ndarray], n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def close(k: int, counts: np.ndarray, n: int) -> None:
        out[k] = _WEIGHTS[2 * counts > n].sum(dtype=np.uint64)

    def flush() -> None:
        nonlocal size
        if held:
            starts = np.cumsum([0, *(len(h) for _, h in held[:-1])])
            for (k, h), counts in zip(held, _set_bits(np.concatenate([h for _, h in held]), starts), strict=True):
                close(k, counts, len(h))
        held.clear()
        size = 0

    for k, h in enumerate(hashes):
        if len(h) > COUNT_AT_ONCE:
            parts = (h[i : i + COUNT_AT_ONCE] for i in range(0, len(h), COUNT_AT_ONCE))
            close(k, sum(_set_bits(p, np.zeros(1, np.int64))[0] for p in parts), len(h))
        elif len(h):
            held.append((k, h))
            size += len(h)
            if size >= COUNT_AT_ONCE:
                flush()
    flush()
    return out.view(np.int64)


def add_fingerprints(df: DataFrame, text: str = "text", width: int = 4, name: str = "fp") -> DataFrame:
    """Replace ``text`` by its fingerprint, a long called ``name``."""
    kept = [f for f in df.schema.fields if f.name not in (text, name)]

    def work(batches):
        for batch in batches:
            texts = pc.cast(batch.column(text), pa.binary()).to_pylist()
            rest = {f.name: batch.column(f.name) for f in kept}
            yield pa.RecordBatch.from_pydict(rest | {name: pa.array(fingerprints(texts, width))})

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{name}` bigint"])
    return df.select(*[f"`{f.name}`" for f in kept], f"`{text}`").mapInArrow(work, schema)


def block_masks(budget: int, n: int) -> list[int]:
    """Bit masks of which any two fingerprints within the budget agree on one at least.

    More blocks give more and longer masks; the number is the least whose buckets would hold
    64 fingerprints on average, so that the work follows the number of fingerprints.
    """
    for blocks in range(budget + 1, budget + 5):
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        parts = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
        masks = [sum(c) for c in combinations(parts, blocks - budget)]
        if n < 64 * 2 ** min(m.bit_count() for m in masks):
            break
    return masks


class _Union:
    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def _all_pairs(al: np.ndarray, ah: np.ndarray, bl: np.ndarray, bh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (x, y) between the places of ranges a and b; within one range each pair once."""
    wide = bh - bl
    count = (ah - al) * wide
    own = np.repeat(np.arange(len(al)), count)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    x, y = al[own] + nth // wide[own], bl[own] + nth % wide[own]
    once = (al[own] != bl[own]) | (x < y)
    return x[once], y[once]


def trie_links(fps: np.ndarray, starts: np.ndarray, budget: int, accept: Callable[..., np.ndarray] | None = None, root: np.ndarray | None = None) -> np.ndarray:
    """Component roots of the tries whose sorted fingerprints begin at ``starts``.

    ``fps`` is uint64 and ascending inside each trie.  A node is a range of a trie; a pair of
    nodes carries the bits by which its two prefixes differ.  ``accept`` says which pairs of
    places within the budget link (all, if there is none); pairs that are linked already
    aren't asked for.  ``root`` is what is linked beforehand.
    """
    n, found = len(fps), _Union(len(fps))
    if root is not None:
        found.root = root.copy()
    ends = np.append(starts[1:], n)
    stack = [(63, starts, ends, starts, ends, np.zeros(len(starts), np.int64))]
    ones: dict[int, np.ndarray] = {}

    def link(x: np.ndarray, y: np.ndarray) -> None:
        near = (x != y) & (np.bitwise_count(fps[x] ^ fps[y]) <= budget) & (found.root[x] != found.root[y])
        x, y = x[near], y[near]
        if accept is not None and len(x):
            good = accept(x, y)
            x, y = x[good], y[good]
        found.join(x, y)

    while stack:
        bit, al, ah, bl, bh, d = stack.pop()
        if len(al) > PAIRS_AT_ONCE:
            half = len(al) // 2
            stack += [(bit, al[half:], ah[half:], bl[half:], bh[half:], d[half:]), (bit, al[:half], ah[:half], bl[:half], bh[:half], d[:half])]
            continue
        # a pair of single leaves is compared at once; a node of one component needs no pair with itself
        one = (ah - al == 1) & (bh - bl == 1)
        if one.any():
            link(al[one], bl[one])
        edge = np.append(np.flatnonzero(np.diff(found.root)) + 1, n)
        same = edge[np.searchsorted(edge, al, "right")] >= ah
        same &= (edge[np.searchsorted(edge, bl, "right")] >= bh) & (found.root[al] == found.root[bl])
        go = ~(one | same)
        al, ah, bl, bh, d = al[go], ah[go], bl[go], bh[go], d[go]
        if not len(al):
            continue
        if bit < 0:  # equal fingerprints on each side
            link(*_all_pairs(al, ah, bl, bh))
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)])
        up = ones[bit]
        am, bm = ah - (up[ah] - up[al]), bh - (up[bh] - up[bl])
        own = al == bl  # a node with itself: each child with itself, and the two children once
        parts = [(al, am, bl, bm, d), (am, ah, bm, bh, d), (al, am, bm, bh, d + 1)]
        parts.append(tuple(x[~own] for x in (am, ah, bl, bm, d + 1)))
        al, ah, bl, bh, d = (np.concatenate(x) for x in zip(*parts, strict=True))
        go = (al < ah) & (bl < bh) & (d <= budget)
        if go.any():
            stack.append((bit - 1, al[go], ah[go], bl[go], bh[go], d[go]))
    return found.root


def _bucket_links(budget: int):
    def links(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        fps = fp.view(np.uint64)
        order = np.lexsort((fps, key, mask))
        mask, key, fps = mask[order], key[order], fps[order]
        root = trie_links(fps, _bucket_starts(mask, key), budget)
        has = np.flatnonzero(root != np.arange(len(root)))
        signed = fps.view(np.int64)
        return pa.RecordBatch.from_pydict({"a": signed[has], "b": signed[root[has]]})

    return _whole_buckets(links, ("m", "k", "fp"))


def _bucket_starts(*keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))


def _whole_buckets(links: Callable[..., pa.RecordBatch], columns: tuple[str, ...], keys: int = 2, at_once: int = ROWS_AT_ONCE):
    """``links`` over rows sorted by bucket (the first ``keys`` columns), never over a part of a bucket."""

    def work(batches):
        held: list[tuple[np.ndarray, ...]] = []
        size, limit = 0, at_once
        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in columns))
            size += batch.num_rows
            if size >= limit:  # whole buckets only: the last one waits for its other rows
                rows = [np.concatenate(x) for x in zip(*held, strict=True)]
                last = np.all([k == k[-1] for k in rows[:keys]], axis=0)
                if not last.all():
                    yield links(*(x[~last] for x in rows))
                held, size = [tuple(x[last] for x in rows)], int(last.sum())
                limit = max(at_once, 2 * size)
        if held and sum(len(x[0]) for x in held):
            yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return work


def fingerprint_links(fps: DataFrame, budget: int = 4) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints of column ``fp``."""
    fps = fps.select("fp").where("fp IS NOT NULL").distinct()
    masks = block_masks(budget, fps.count())
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(signed)])
    rows = fps.select("fp", F.explode(keys).alias("x")).select("x.m", "x.k", "fp")
    counted = rows.repartition("m", "k").sortWithinPartitions("m", "k")
    return counted.mapInArrow(_bucket_links(budget), "a bigint, b bigint")


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 4, budget: int = 4) -> DataFrame:
    """documents without ``text``, plus ``fp`` (long) and ``component_id``: the least id reachable."""
    df = documents.drop("fp", "component_id")
    marked = store.materialize(add_fingerprints(df, text, width), "fingerprints")
    # the least id of each fingerprint, combined before the shuffle
    nodes = store.materialize(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "nodes")
    labels = components(fingerprint_links(nodes, budget))
    named = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_fp = store.materialize(named.join(names, "label").select("fp", "component_id"), "members")
    return marked.join(by_fp, "fp", "left")


#: Two sets of shingles with similarity 0.8 share a band with probability 1 - (1 - 0.8 ** 4) ** 20 = 0.99997.
BANDS, BAND_ROWS = 20, 4
_ORDERS = np.random.default_rng(5).integers(1 << 63, size=BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bits by which fingerprints of one band may differ; at similarity 0.8 they differ in 9.7, with a deviation of 2.9.
BAND_BUDGET = 20
#: Bands of up to so many texts hand on their pairs; in larger ones sets of shingles meet, in blocks of so many texts.
FEW, BLOCK = 16, 2000
#: Sets of up to so many shingles are compared whole where they meet; larger ones by a share of about as many, then whole.
SET_WHOLE = 4096


def _sketch(h: np.ndarray) -> tuple[int, int, list[int]]:
    """(name, size, bands) of a set of shingle hashes; equal sets have equal names."""
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    h = np.unique(h)
    if not len(h):
        return 0, 0, []
    least = np.full(len(_ORDERS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(h), 4096):
        np.minimum(least, (_ORDERS[:, None] * h[i : i + 4096]).min(axis=1), out=least)
    bands = [signed(xxhash.xxh64_intdigest(least[k : k + BAND_ROWS].tobytes(), SEED + k)) for k in range(0, len(least), BAND_ROWS)]
    return signed(xxhash.xxh64_intdigest(h.tobytes(), SEED)), len(h), bands


def add_sketches(df: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """(id, node, n, fp, bands): the set of shingles by name and size, its fingerprint and its bands."""

    def work(batches):
        for batch in batches:
            made = []

            def each(texts):
                for t in texts:
                    h = shingle_hashes(t, width)
                    made.append(_sketch(h))
                    yield h

            fps = fingerprints_of(each(pc.cast(batch.column(text), pa.binary()).to_pylist()), batch.num_rows)
            node, n, bands = zip(*made, strict=True) if made else ((), (), ())
            cols = {"node": pa.array(node, pa.int64()), "n": pa.array(n, pa.int64()), "fp": pa.array(fps), "bands": pa.array(bands, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_pydict({id_col: batch.column(id_col)} | cols)

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text).mapInArrow(work, f"`{id_col}` {kind}, node bigint, n bigint, fp bigint, bands array<bigint>")


def _links_batch(a: np.ndarray, b: np.ndarray, **more) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)} | more)


def _sizes_allow(n: np.ndarray, x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    return np.minimum(n[x], n[y]) >= similarity * np.maximum(n[x], n[y])


def _pairs_in_band(similarity: float):
    """Pairs of a small band within the budget, but for sizes that rule the similarity out."""

    def links(key: np.ndarray, node: np.ndarray, n: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        fps = fp.view(np.uint64)
        order = np.lexsort((fps, key))
        key, fps, node, n = key[order], fps[order], node[order], n[order]
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))]

        def note(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            ok = _sizes_allow(n, x, y, similarity)
            found.append((node[x[ok]], node[y[ok]]))
            return np.zeros(len(x), bool)  # nothing is linked before it is verified

        trie_links(fps, _bucket_starts(key), BAND_BUDGET, note)
        return _links_batch(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return links


def shingle_set(h: np.ndarray, whole: int) -> bytes:
    """32 bits of each shingle hash in order; of over ``whole`` only those that begin with enough zeros."""
    h = np.unique(h >> np.uint64(32)).astype(np.uint32)
    zeros = max(0, (len(h) - 1) // whole).bit_length()
    return (np.uint8(zeros).tobytes() + h[h < (1 << 32 - zeros)].tobytes()) if zeros else b"\0" + h.tobytes()


class _Sets:
    """Sets of shingles of one block, by the texts that hold each shingle."""

    def __init__(self, packed: np.ndarray, n: np.ndarray, similarity: float):
        self.n, self.similarity = n, similarity
        self.zeros = np.array([p[0] for p in packed])
        sets = [np.frombuffer(p, np.uint32, offset=1) for p in packed]
        self.size = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), self.size)
        self.values, own = np.unique(np.concatenate(sets), return_inverse=True)
        self.mine = np.split(own, np.cumsum(self.size)[:-1])
        by = np.argsort(own, kind="stable")
        self.holders, self.ends = owner[by], np.cumsum(np.bincount(own, minlength=len(self.values)))
        self.unsure: list[tuple[int, int]] = []

    def accept(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs have the similarity; those of sets held in part are noted and left for later."""
        good = np.zeros(len(x), bool)
        ok = np.flatnonzero(_sizes_allow(self.n, x, y, self.similarity))
        ok = ok[np.argsort(x[ok], kind="stable")]
        cut = np.flatnonzero(np.diff(x[ok])) + 1
        for at in np.split(ok, cut) if len(ok) else ():
            k = x[at[0]]
            zeros = np.maximum(self.zeros[k], self.zeros[y[at]])
            for z in np.unique(zeros):
                some = at[zeros == z]
                good[some] = self._near(k, y[some], int(z))
        return good

    def _near(self, k: int, others: np.ndarray, zeros: int) -> np.ndarray:
        mine = self.mine[k]
        if zeros:
            mine = mine[self.values[mine] < (1 << 32 - zeros)]
        ends = self.ends[mine]
        count = ends - np.where(mine > 0, self.ends[mine - 1], 0)
        at = np.arange(count.sum()) + np.repeat(ends - np.cumsum(count), count)
        both = np.bincount(self.holders[at], minlength=len(self.n))[others]
        if not zeros:
            return both >= self.similarity * (len(mine) + self.size[others] - both)
        limit = np.uint32(1 << 32 - zeros)
        size = np.array([np.count_nonzero(self.values[self.mine[j]] < limit) for j in others])
        union = np.maximum(len(mine) + size - both, 1)  # a share of so many is off by 0.4 over the root of their number
        close = both >= (self.similarity - 2.4 / np.sqrt(union)) * union
        self.unsure += [(k, int(j)) for j in others[close]]
        return np.zeros(len(others), bool)


def _sets_in_block(similarity: float):
    """Spanning links of each block by the trie join, every link verified on the sets; ``sure`` is false where they are held in part."""

    def links(key: np.ndarray, block: np.ndarray, node: np.ndarray, n: np.ndarray, fp: np.ndarray, label: np.ndarray, packed: np.ndarray) -> pa.RecordBatch:
        fps = fp.view(np.uint64)
        order = np.lexsort((fps, block, key))
        key, block, fps, node, n, label, packed = (v[order] for v in (key, block, fps, node, n, label, packed))
        starts = _bucket_starts(key, block)
        out: list[tuple] = []
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], strict=True):
            own = slice(lo, hi)
            _, first, group = np.unique(label[own], return_index=True, return_inverse=True)
            if len(first) == 1:
                continue
            # the least place of a label is its root
            sets, before = _Sets(packed[own], n[own], similarity), first[group]
            made: list[tuple[np.ndarray, np.ndarray]] = []

            def accept(x, y, sets=sets, made=made):
                good = sets.accept(x, y)
                made.append((x[good], y[good]))
                return good

            trie_links(fps[own], np.zeros(1, np.int64), BAND_BUDGET, accept, before)
            out += [(node[lo + x], node[lo + y], np.ones(len(x), bool)) for x, y in _spanning(made, before)]
            if sets.unsure:
                x, y = np.array(sets.unsure).T
                out.append((node[lo + x], node[lo + y], np.zeros(len(x), bool)))
        a, b, sure = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
        return _links_batch(a, b, sure=sure)

    return links


def _spanning(made: list[tuple[np.ndarray, np.ndarray]], root: np.ndarray):
    """Of the links, those that join what the ones before them have left apart."""
    up = root.tolist()

    def find(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    for x, y in made:
        keep = []
        for i, (a, b) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
            a, b = find(a), find(b)
            if a != b:
                up[max(a, b)] = min(a, b)
                keep.append(i)
        yield x[keep], y[keep]


def _similar(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles have the similarity; ``texts`` has one text a node."""

    def work(batches):
        for batch in batches:
            sides = [pc.cast(batch.column(c), pa.binary()).to_pylist() for c in ("ta", "tb")]
            keep = []
            for x, y in zip(*sides, strict=True):
                x, y = (np.unique(shingle_hashes(t, width)) for t in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"t{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb").mapInArrow(work, "a bigint, b bigint")


def _packed(texts: DataFrame, width: int, whole: int) -> DataFrame:
    """(node, packed): each text's set of shingles."""

    def work(batches):
        for batch in batches:
            sets = [shingle_set(shingle_hashes(t, width), whole) for t in pc.cast(batch.column("text"), pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "packed": pa.array(sets, pa.binary())})

    return texts.select("node", "text").mapInArrow(work, "node bigint, packed binary")


def similar_documents(documents: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, component_id) of documents that link by Jaccard similarity of their word shingles.

    Fingerprints of pairs at 0.8 differ in some 10 bits, beyond what masks of blocks can find,
    so here the buckets are bands of least hashes, and the trie join of a band gives its pairs
    within 20 bits.  A band of few texts hands its pairs on, to be verified on the texts.  In
    a larger one the texts' sets of shingles come along, in blocks that bound a task, and the
    join verifies its pairs at once and hands on spanning links only, never all its pairs.
    Every link is verified on whole sets of shingles.  Ids must not be null.
    """
    made = store.materialize(add_sketches(documents, id_col, text, width), "sketches")
    nodes = store.materialize(made.groupBy("node").agg(F.min(id_col).alias("least"), F.first("n").alias("n"), F.min("fp").alias("fp"), F.first("bands").alias("bands")), "nodes")
    rows = nodes.select("node", "n", "fp", F.explode("bands").alias("k"))
    sizes = store.materialize(rows.groupBy("k").agg(F.count("*").alias("size")).where("size > 1"), "bands")
    shared = store.materialize(rows.join(sizes, "k"), "shared")

    def texts_of(used: DataFrame) -> DataFrame:
        ids = nodes.join(used.select("node").distinct(), "node", "left_semi").select("node", F.col("least").alias(id_col))
        return documents.select(id_col, F.col(text).alias("text")).join(ids, id_col).groupBy("node").agg(F.first("text").alias("text"))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = store.materialize(pairs.select("a", "b").distinct(), "pairs")
        texts = store.materialize(texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b"))), "texts")
        return store.materialize(_similar(pairs, texts, width, similarity), "similar")

    few = shared.where(F.col("size") <= FEW).repartition("k").sortWithinPartitions("k")
    near = verified(few.mapInArrow(_whole_buckets(_pairs_in_band(similarity), ("k", "node", "n", "fp"), 1), "a bigint, b bigint"))
    labels = components(near)
    many = shared.where(F.col("size") > FEW).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = many.groupBy("k").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("k")
    many = store.materialize(many.join(mixed, "k", "left_semi"), "crowds")
    if not many.isEmpty():
        sets = store.materialize(_packed(texts_of(many), width, SET_WHOLE), "sets")
        # a band of several blocks: each two of them meet once, so a text goes to as many tasks as there are blocks
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        dealt = many.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        pair = F.least("own", "other").cast("long") * F.lit(1 << 31) + F.greatest("own", "other")
        dealt = dealt.select("k", pair.alias("block"), "node", "n", "fp", "label").join(sets, "node")
        dealt = dealt.repartition("k", "block").sortWithinPartitions("k", "block")
        work = _whole_buckets(_sets_in_block(similarity), ("k", "block", "node", "n", "fp", "label", "packed"), 2, 2 * BLOCK)
        links = store.materialize(dealt.mapInArrow(work, "a bigint, b bigint, sure boolean"), "links")
        near = near.unionByName(links.where("sure").select("a", "b")).unionByName(verified(links.where("NOT sure")))
        labels = components(near)
    named = nodes.join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return made.select(id_col, "node").join(named.join(names, "label").select("node", "component_id"), "node").select(id_col, "component_id")


def op7_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = near_duplicates(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
