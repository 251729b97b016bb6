"""Byte-level BPE: a priority queue of merge ranks over a doubly linked list of symbols.

Each piece of text becomes a linked list of byte symbols.  All neighbouring pairs that merge
go into a heap by (rank, place); the least entry is taken, skipped where one of its two
symbols has changed since, and else merged, which links the list anew and adds at most two
entries.  That is O(n log n) for a piece of any length.  Decoding concatenates the vocabulary
strings and reads the bytes as UTF-8, bad bytes becoming U+FFFD.

Pieces repeat, so a worker keeps a bounded table of pieces it has encoded; the table changes
the cost only.  The vocabulary file is a parameter and is read on the executors.

Defined cases: null and empty texts give no tokens and decode to the empty text; the special
token's string in a text is that token, as the library has it; repeated rows and further
columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pieces kept in a worker's table: bounds its memory at some 100 MB.
PIECES_KEPT = 250_000
#: A longer piece is encoded but not kept.
LONGEST_KEPT = 64

#: Bits of an id, and of a place in a piece.
ID_BITS, PLACE_BITS = 24, 40
ID, PLACE = (1 << ID_BITS) - 1, (1 << PLACE_BITS) - 1

# Fixed value: the pre-tokenizer's pattern; white space as Unicode's White_Space property.
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
CLASSES = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\p{White_Space}"}


def splitters() -> tuple:
    """The pattern for ASCII texts, for texts without characters beyond U+FFFF, and for all.

    The first two have their classes written out, which the plain engine matches faster.
    """

    def fill(classes: dict[str, str]) -> str:
        out = SPLIT
        for name, value in classes.items():
            out = out.replace("{" + name + "}", value)
        return out

    def spelled(last: int) -> dict[str, str]:
        every = "".join(chr(c) for c in range(last) if not 0xD800 <= c < 0xE000)
        out = {}
        for name, value in CLASSES.items():
            runs = [(m[0][0], m[0][-1]) for m in regex.finditer(f"[{value}]+", every)]
            out[name] = "".join(f"\\u{ord(a):04x}-\\u{ord(z):04x}" for a, z in runs)
        return out

    return re.compile(fill(spelled(0x80))), re.compile(fill(spelled(0x10000))), regex.compile(fill(CLASSES))


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself if printable, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(0x100 + len(letters) - len(plain))
    return letters


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        vocab = spec["model"]["vocab"]
        self.strings = {i: bytes(back[c] for c in w) for w, i in vocab.items()}
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        self.pairs: dict[int, int] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.pairs.setdefault(vocab[a] << ID_BITS | vocab[b], rank << ID_BITS | vocab[a + b])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: w.encode() for w, i in self.added.items()}
        self.ascii, self.plain, self.full = splitters()
        self.decimals = {i: str(i).encode() for i in self.strings}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.kept: dict[str, tuple[int, bytes, bytes]] = {}
        self.lists: dict[str, tuple[tuple[int, ...], bytes]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece.

        Heap entries are single numbers: rank and merged id above, place below.  ``best`` has
        for each place the merge of its pair as it is now; an entry that differs is stale.
        """
        ids = [self.byte_ids[b] for b in piece]
        n = len(ids)
        if n == 1:
            return ids
        get, push, pop = self.pairs.get, heapq.heappush, heapq.heappop
        best = [get(a << ID_BITS | b) for a, b in zip(ids, ids[1:])]
        best.append(None)
        heap = [v << PLACE_BITS | k for k, v in enumerate(best) if v is not None]
        if not heap:
            return ids
        heapq.heapify(heap)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        while heap:
            e = pop(heap)
            k = e & PLACE
            if best[k] != e >> PLACE_BITS:
                continue
            r = right[k]
            ids[k] = new = best[k] & ID
            ids[r] = -1
            best[r] = None
            right[k] = after = right[r]
            if after < n:
                left[after] = k
                best[k] = v = get(new << ID_BITS | ids[after])
                if v is not None:
                    push(heap, v << PLACE_BITS | k)
            else:
                best[k] = None
            p = left[k]
            if p >= 0:
                best[p] = v = get(ids[p] << ID_BITS | new)
                if v is not None:
                    push(heap, v << PLACE_BITS | p)
        return [i for i in ids if i >= 0]

    def piece(self, text: str) -> tuple[int, bytes, bytes]:
        """(tokens, ids in decimals joined by commas, decoded bytes) of one piece."""
        ids = self.merge(text.encode("utf-8", "surrogatepass"))
        out = len(ids), b",".join(map(self.decimals.__getitem__, ids)), b"".join(map(self.strings.__getitem__, ids))
        if len(text) <= LONGEST_KEPT:
            if len(self.kept) >= PIECES_KEPT:
                self.kept.clear()
            self.kept[text] = out
        return out

    def _split(self, text: str) -> list[str]:
        engine = self.ascii if text.isascii() else self.plain if not text or max(text) < "\U00010000" else self.full
        return engine.findall(text)

    def _pieces(self, text: str):
        if self.cut is None or not any(w in text for w in self.added):
            return self._split(text)
        out = []
        for k, part in enumerate(self.cut.split(text)):
            out += [part] if k % 2 else self._split(part)
        return out

    def digest(self, text: str) -> tuple[int, str, str]:
        """(n_tokens, SHA-256 of the ids, SHA-256 of the decoded text) of a whole text."""
        get, found = self.kept.get, []
        for p in self._pieces(text):
            hit = get(p)
            if hit is None:
                hit = self._added(p) if p in self.added else self.piece(p)
            found.append(hit)
        sizes, ids, raw = zip(*found, strict=True) if found else ((), (), ())
        decoded = b"".join(raw)
        try:
            decoded.decode()
        except UnicodeDecodeError:
            decoded = decoded.decode("utf-8", "replace").encode()
        return sum(sizes), hashlib.sha256(b",".join(ids)).hexdigest(), hashlib.sha256(decoded).hexdigest()

    def pieces_of(self, text: str):
        """(ids, decoded bytes) of each piece of a text."""
        get = self.lists.get
        for p in self._pieces(text):
            hit = get(p)
            if hit is None:
                ids = (self.added[p],) if p in self.added else tuple(self.merge(p.encode("utf-8", "surrogatepass")))
                hit = ids, b"".join(map(self.strings.__getitem__, ids))
                if len(p) <= LONGEST_KEPT:
                    if len(self.lists) >= PIECES_KEPT:
                        self.lists.clear()
                    self.lists[p] = hit
            yield hit

    def _added(self, word: str) -> tuple[int, bytes, bytes]:
        i = self.added[word]
        return 1, str(i).encode(), self.strings[i]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for p in self._pieces(text):
            out += [self.added[p]] if p in self.added else self.merge(p.encode("utf-8", "surrogatepass"))
        return out

    def decode(self, ids) -> str:
        return b"".join(self.strings[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def _with(df: DataFrame, text: str, schema: str, columns):
    """df plus columns made of each batch's texts by ``columns(list of str) -> dict``."""
    kept = df.schema.fields

    def work(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            rest = {f.name: batch.column(f.name) for f in kept}
            yield pa.RecordBatch.from_pydict(rest | columns(texts))

    had = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return df.mapInArrow(work, f"{had}, {schema}")


def encode(documents: DataFrame, path: str, text: str = "text") -> DataFrame:
    """documents plus ``ids`` (array of int)."""

    def columns(texts):
        bpe = tokenizer(path)
        return {"ids": pa.array([bpe.encode(t) for t in texts], pa.list_(pa.int32()))}

    return _with(documents.drop("ids"), text, "ids array<int>", columns)


def encode_checked(documents: DataFrame, path: str, text: str = "text") -> DataFrame:
    """documents plus ``ids``, ``n_tokens`` and ``decodes``: whether the ids give the text again."""

    def columns(texts):
        bpe = tokenizer(path)
        flat, ends, same = array("i"), [0], []
        for t in texts:
            decoded = []
            for ids, raw in bpe.pieces_of(t):
                flat.extend(ids)
                decoded.append(raw)
            ends.append(len(flat))
            same.append(b"".join(decoded).decode("utf-8", "replace") == t)
        ends = np.array(ends, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(flat, np.int32)))
        return {"ids": lists, "n_tokens": pa.array(np.diff(ends).astype(np.int64)), "decodes": pa.array(same)}

    return _with(documents.drop("ids", "n_tokens", "decodes"), text, "ids array<int>, n_tokens bigint, decodes boolean", columns)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """encoded plus ``decoded``; a null list decodes to the empty text."""
    df = encoded.drop("decoded")
    kept = df.schema.fields

    def work(batches):
        bpe = tokenizer(path)
        for batch in batches:
            rest = {f.name: batch.column(f.name) for f in kept}
            yield pa.RecordBatch.from_pydict(rest | {"decoded": pa.array([bpe.decode(x or []) for x in batch.column(ids).to_pylist()], pa.string())})

    had = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return df.mapInArrow(work, f"{had}, decoded string")


def round_trip(documents: DataFrame, path: str, text: str = "text") -> DataFrame:
    """documents without ``text``, plus n_tokens, ids_sha256 and decoded_sha256."""
    df = documents.drop("n_tokens", "ids_sha256", "decoded_sha256")
    kept = [f for f in df.schema.fields if f.name != text]

    def work(batches):
        bpe = tokenizer(path)
        for batch in batches:
            found = [bpe.digest(t or "") for t in batch.column(text).to_pylist()]
            n, ids, decoded = zip(*found, strict=True) if found else ((), (), ())
            rest = {f.name: batch.column(f.name) for f in kept}
            made = {"n_tokens": pa.array(np.array(n, np.int64)), "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}
            yield pa.RecordBatch.from_pydict(rest | made)

    had = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return df.mapInArrow(work, f"{had}n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return round_trip(docs, default_path())
