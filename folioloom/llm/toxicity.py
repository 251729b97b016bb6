"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are of documents.  Token labels follow from them: in toxic documents, a word is toxic
if it or a beginning of it is such that its distinct contexts (the words on both sides) are many in toxic documents and few
in others; contexts, not occurrences, so that copies of a document count once.  The field has
two states, emission weights for a word, its beginnings and ending, its shape and its two neighbours, and
transition weights, fitted by gradient steps on the exact likelihood.  Forward-backward
marginals of the tokens give offending spans and, through a logistic curve fitted on the same
sample, the document's score.

Only a bounded sample of labelled rows is fitted (``per_class`` documents of each label, none
over ``longest`` characters, by a hash of the text); every document is scored whole.

Defined cases: null and empty texts get the score of a text without toxic tokens; without
labelled toxic rows the field finds nothing; where labels of one document or one text clash, it
is toxic; repeated rows and further columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENS_KEPT = 200_000
DOCS_AT_ONCE = 1000
#: Tokens that a chain steps through at once; longer chains go in pieces that exchange messages.
STEPS = 100
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_END = re.compile(r"[.!?]")


def normal(token: str) -> str:
    return _EDGE.sub("", token).lower()


def _pieces(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, chain, turn) of pieces of up to ``STEPS`` tokens that make up the chains."""
    count = -(-lengths // STEPS)
    chain = np.repeat(np.arange(len(starts)), count)
    turn = np.arange(len(chain)) - np.repeat(np.cumsum(count) - count, count)
    at = starts[chain] + STEPS * turn
    return at, np.minimum(STEPS, starts[chain] + lengths[chain] - at), chain, turn


def _messages(x: np.ndarray, at: np.ndarray, n: np.ndarray, chain: np.ndarray, turn: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each piece P(state 1) of the token before it, and the share of state 1 in what follows its last token.

    The steps of a piece multiply into one 2 x 2 matrix, so that a chain takes a step a piece.
    """
    before, after = np.full(len(at), 0.5), np.full(len(at), 0.5)
    later = np.flatnonzero(turn > 0)
    m = np.broadcast_to(np.eye(2), (len(later), 2, 2)).copy()
    for k in range(int(n[later].max(initial=0))):
        go = np.flatnonzero(n[later] > k)
        step = t[None] * np.stack([np.ones(len(go)), x[at[later[go]] + k]], axis=1)[:, None, :]
        m[go] = m[go] @ step
        m[go] /= m[go].sum(axis=(1, 2), keepdims=True)
    whole = np.zeros((len(at), 2, 2))
    whole[later] = m
    # the first piece of a chain that goes on, step by step from its beginning
    heads = np.flatnonzero((turn == 0) & (np.append(chain[1:], -1) == chain))
    v = np.full((len(heads), 2), 0.5)
    v[:, 1] *= x[at[heads]]
    v /= v.sum(axis=1, keepdims=True)
    for k in range(1, STEPS):  # a piece that isn't the last is full
        v = v @ t
        v[:, 1] *= x[at[heads] + k]
        v /= v.sum(axis=1, keepdims=True)
    place = heads
    while len(place):
        place = place + 1
        before[place] = v[:, 1]
        v = np.einsum("ki,kij->kj", v, whole[place])
        v /= v.sum(axis=1, keepdims=True)
        on = np.append(chain, -1)[place + 1] == chain[place]
        place, v = place[on], v[on]
    place = np.flatnonzero((turn > 0) & (np.append(chain[1:], -1) != chain))  # last pieces, back to the first
    v = np.full((len(place), 2), 0.5)
    while len(place):
        v = np.einsum("kij,kj->ki", whole[place], v)
        v /= v.sum(axis=1, keepdims=True)
        place = place - 1
        after[place] = v[:, 1]
        on = turn[place] > 0
        place, v = place[on], v[on]
    return before, after


def marginals(e: np.ndarray, starts: np.ndarray, lengths: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """(P(state 1) of each token, log Z, expected transition counts) of sequences in one flat array.

    ``e`` is the emission score of state 1 against state 0; ``trans`` is 2 x 2 in logs.  All
    sequences take a step together, longest first, so that the active ones are a prefix; a
    long one goes in pieces, whose messages from both sides make the marginals those of the whole.
    """
    n = len(e)
    t = np.exp(trans)
    (t00, t01), (t10, t11) = t
    x = np.exp(np.clip(e, -30, 30))
    at, size, chain, turn = _pieces(starts, lengths)
    before, after = _messages(x, at, size, chain, turn, t)
    order = np.argsort(-size, kind="stable")
    at_, lengths = at[order], size[order]
    before, after, goes_on = before[order], after[order], turn[order] > 0
    a, b, z = np.empty(n), np.empty(n), np.empty(n)  # P(1 | prefix), share of state 1 in the suffix weight, step weight
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")  # pieces longer than k
    p = before
    for k in range(longest):
        here = at_[: active[k]] + k
        p = p[: active[k]]
        one, zero = (p * t11 + (1 - p) * t01) * x[here], p * t10 + (1 - p) * t00
        if not k:
            one, zero = np.where(goes_on, one, x[here] * 0.5), np.where(goes_on, zero, 0.5)
        s = one + zero
        p = one / s
        a[here], z[here] = p, s
    q = np.empty(0)
    for k in range(longest - 1, -1, -1):
        now = active[k]
        here = at_[:now] + k
        fresh = after[:now].copy()
        if len(q):
            nxt = here[: len(q)] + 1
            w1 = q * x[nxt]
            w0 = 1 - q
            one, zero = t11 * w1 + t10 * w0, t01 * w1 + t00 * w0
            fresh[: len(q)] = one / (one + zero)
        q = fresh
        b[here] = q
    top = a * b
    post = top / (top + (1 - a) * (1 - b))
    if not pairs:
        return post
    first = np.zeros(n, bool)
    first[starts] = True
    j = np.flatnonzero(~first)
    i = j - 1
    w = np.empty((len(j), 2, 2))
    for u in (0, 1):
        left = a[i] if u else 1 - a[i]
        for v in (0, 1):
            w[:, u, v] = left * math.exp(trans[u, v]) * (x[j] * b[j] if v else 1 - b[j])
    w /= w.sum(axis=(1, 2), keepdims=True)
    return post, float(np.log(z).sum()), w.sum(axis=0)


def sequences(ends: np.ndarray, n_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of chains: a token that ends a sentence, or a document's last, closes one."""
    close = ends.astype(bool).copy()
    close[np.cumsum(n_docs)[n_docs > 0] - 1] = True
    last = np.flatnonzero(close)
    starts = np.concatenate([[0], last[:-1] + 1]) if len(last) else np.empty(0, np.int64)
    return starts, last - starts + 1


PREFIXES = (4, 5, 6, 7)


def token_features(w: str, raw: str) -> list[str]:
    """The word, its beginnings and ending, and its shape; always the same number of features."""
    begins = [f"b={w[:k]}" if len(w) >= k else "" for k in PREFIXES]
    return [f"w={w}", *begins, f"e={w[-3:]}", f"s={'A' if raw.isupper() else 'a'}{min(len(w), 12)}"]


def stems(w: str) -> set[str]:
    """A word and its beginnings: inflected words share one."""
    return {w, *(w[:k] for k in PREFIXES if len(w) > k)} if w else set()


@dataclass
class Field:
    """Weights of a fitted field; features that the sample hasn't shown weigh nothing."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -8.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple[float, ...] = (-4.0, 0.0, 0.0, 0.0)

    def emissions(self, raw: str) -> tuple[float, float, float, bool]:
        w, get = normal(raw), self.weights.get
        own = sum(get(f, 0.0) for f in token_features(w, raw))
        return own + self.bias, get(f"p={w}", 0.0), get(f"n={w}", 0.0), bool(_END.search(raw))

    def scores(self, post: np.ndarray, n_docs: np.ndarray) -> np.ndarray:
        x = doc_features(post, n_docs)
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + x @ np.array(self.curve[1:]), -30, 30)))


def doc_features(post: np.ndarray, n_docs: np.ndarray) -> np.ndarray:
    """For each document the greatest marginal's log odds and the logs of the toxic tokens expected and of all."""
    out = np.zeros((len(n_docs), 3))
    out[:, 0] = -6.0
    out[:, 2] = np.log1p(n_docs)
    full = np.flatnonzero(n_docs > 0)
    if len(full):
        starts = (np.cumsum(n_docs) - n_docs)[full]
        top = np.clip(np.maximum.reduceat(post, starts), 1e-6, 1 - 1e-6)
        out[full, 0] = np.clip(np.log(top / (1 - top)), -6, 6)
        out[full, 1] = np.log1p(np.add.reduceat(np.where(post > 0.1, post, 0), starts))
    return out


class Tagger:
    """Marginals for batches of texts; keeps a bounded table of the tokens seen."""

    def __init__(self, model: Field):
        self.model, self.rows, self.ids = model, [], {}

    def run(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.rows) > TOKENS_KEPT:
            self.rows, self.ids = [], {}
        ids, rows, emissions = self.ids, self.rows, self.model.emissions
        flat: list[np.ndarray] = []
        for text in texts:
            tokens = text.split()
            for t in set(tokens).difference(ids):
                ids[t] = len(rows)
                rows.append(emissions(t))
            flat.append(np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens)))
        n_docs = np.array([len(x) for x in flat], np.int64)
        if not n_docs.sum():
            return np.empty(0), n_docs
        table = np.array(rows, np.float64)
        at = np.concatenate(flat)
        e = table[at, 0]
        starts, lengths = sequences(table[at, 3], n_docs)
        first = np.zeros(len(at), bool)
        first[starts] = True
        e[1:] += np.where(first[1:], 0, table[at[:-1], 1])
        e[:-1] += np.where(first[1:], 0, table[at[1:], 2])
        return marginals(e, starts, lengths, self.model.trans), n_docs


def toxic_stems(docs: list[list[str]], labels: list[int], surplus: float = 3.4) -> set[str]:
    """Words and beginnings that toxic documents hold far more often than others.

    With ``a`` toxic and ``b`` other documents, scaled to equal classes, a stem is
    kept if a - b is at least ``surplus`` standard deviations, sqrt(a + b).  Then ``a`` is held
    to the stem's distinct contexts, which copies of a document don't add to.
    """
    n1, n0 = max(1, sum(labels)), max(1, len(labels) - sum(labels))

    def stands_out(a: float, b: float) -> bool:
        b *= n1 / n0
        return a - b >= surplus * math.sqrt(max(a + b, 1))

    def counted(label: int, among: set[str] | None) -> Counter:
        out: Counter = Counter()
        for words, own in zip(docs, labels, strict=True):
            if own == label:
                here = set().union(*map(stems, set(words)))
                out.update(here if among is None else here & among)
        return out

    held = counted(1, None)
    held = {w: n for w, n in held.items() if stands_out(n, 0)}
    others = counted(0, set(held))
    near = {w for w, n in held.items() if stands_out(n, others[w])}
    seen: dict[str, set] = defaultdict(set)
    for words, label in zip(docs, labels, strict=True):
        if label:
            for k, w in enumerate(words):
                for x in stems(w) & near:
                    seen[x].add((words[k - 1] if k else "", words[k + 1] if k + 1 < len(words) else ""))
    return {w for w in near if stands_out(min(held[w], len(seen[w])), others[w])}


def fit(texts: list[str], labels: list[int], prior: float | None = None, steps: int = 12, rate: float = 0.8, ridge: float = 0.5) -> Field:
    """Fit a field and the curve of its document scores.

    Weights belong to kinds of tokens, so a gradient step costs one pass over the tokens and
    one over the kinds.
    """
    kinds: dict[str, int] = {}
    flat = [np.fromiter((kinds.setdefault(r, len(kinds)) for r in t.split()), np.int64) for t in texts]
    words = [normal(r) for r in kinds]
    bad = toxic_stems([[words[k] for k in ids.tolist()] for ids in flat], labels)
    model = Field()
    if not bad or not any(labels) or all(labels):
        return model
    at, n_docs = np.concatenate(flat), np.array([len(ids) for ids in flat], np.int64)
    count = np.bincount(at, minlength=len(kinds))
    often: Counter = Counter()
    for w, r, n in zip(words, kinds, count.tolist(), strict=True):
        for f in token_features(w, r):
            often[f] += n
    names = {f: k + 1 for k, f in enumerate(sorted(f for f, n in often.items() if f and n >= 3))}  # 0: no weight
    del often
    own = np.array([[names.get(f, 0) for f in token_features(w, r)] for w, r in zip(words, kinds, strict=True)], np.int32)
    side = own[:, 0]  # neighbours weigh by their word
    toxic = np.array([not stems(w).isdisjoint(bad) for w in words])
    y = (toxic[at] & np.repeat(np.array(labels, bool), n_docs)).astype(np.float64)
    starts, lengths = sequences(np.array([bool(_END.search(r)) for r in kinds])[at], n_docs)
    inner = np.ones(len(at), bool)
    inner[starts] = False
    j = np.flatnonzero(inner)
    before, after, size = side[at[j - 1]], side[at[j]], len(names) + 1
    w, wp, wn, trans = np.zeros(size), np.zeros(size), np.zeros(size), np.zeros((2, 2))
    bias = np.array([math.log((y.sum() + 1) / (len(y) - y.sum() + 1))])
    seen = np.bincount((2 * y[j - 1] + y[j]).astype(np.int64), minlength=4).reshape(2, 2)
    params = [w, wp, wn, trans, bias]
    sums = [np.zeros_like(x) for x in params]
    for _ in range(steps):
        e = w[own].sum(axis=1)[at] + bias[0]
        e[j] += wp[before]
        e[j - 1] += wn[after]
        post, _, pairs = marginals(e, starts, lengths, trans, pairs=True)
        gap = y - post
        by_kind = np.bincount(at, gap, len(kinds))
        grads = [
            np.bincount(own.ravel(), np.repeat(by_kind, own.shape[1]), size) - ridge * w,
            np.bincount(before, gap[j], size) - ridge * wp, np.bincount(after, gap[j - 1], size) - ridge * wn,
            seen - pairs, np.array([gap.sum()]),
        ]
        for x, s, g in zip(params, sums, grads, strict=True):
            s += g * g
            x += rate * g / np.sqrt(s + 1e-8)
        for x in (w, wp, wn):
            x[0] = 0
    weights = {}
    for f, k in names.items():
        weights[f] = float(w[k])
        if f[0] == "w":
            weights["p" + f[1:]], weights["n" + f[1:]] = float(wp[k]), float(wn[k])
    model = Field({f: x for f, x in weights.items() if abs(x) > 1e-3}, float(bias[0]), trans)
    post, n = Tagger(model).run(texts)
    model.curve = _curve(doc_features(post, n), np.array(labels, np.float64), prior)
    return model


def _curve(x: np.ndarray, y: np.ndarray, prior: float | None, steps: int = 400) -> tuple[float, ...]:
    """Logistic curve by Newton steps with a small ridge; ``prior`` is the share of toxic rows outside."""
    a = np.column_stack([np.ones(len(x)), x])
    v, ridge = np.zeros(4), np.diag([1e-3, 0.05, 0.05, 0.05]) * len(x) * 0.01
    for _ in range(min(steps, 50)):
        p = 1 / (1 + np.exp(-np.clip(a @ v, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge + 1e-9 * np.eye(4), a.T @ (y - p) - ridge @ v)
        v = v + step
        if np.abs(step).max() < 1e-8:
            break
    if prior is not None and 0 < prior < 1:
        own = y.mean()
        v[0] += math.log(prior / (1 - prior)) - math.log(own / (1 - own))
    return tuple(map(float, v))


HELD_OUT = "crc32(cast(doc_id AS string)) % 4 = 2"


def fit_from(documents: DataFrame, labels: DataFrame, per_class: int = 1000, longest: int = 20_000) -> Field:
    """Fit on at most ``per_class`` documents of each label, from rows that aren't held out."""
    rows = labels.where(f"NOT coalesce({HELD_OUT}, false)").where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    shares = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    some = None
    for label in (0, 1):  # more rows than asked, for those that are too long or not there
        part = rows.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(2 * per_class)
        some = part if some is None else some.unionByName(part)
    texts = documents.where(f"text IS NOT NULL AND length(text) <= {longest}").select("doc_id", "text")
    found = texts.join(F.broadcast(some), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    sample: list[tuple[int, str]] = []
    for label in (0, 1):
        top = found.where(F.col("toxic") == label).orderBy(F.xxhash64("text"), "text").limit(per_class)
        sample += [(r["toxic"], r["text"]) for r in top.collect()]
    total = sum(shares.values())
    prior = shares.get(1, 0) / total if total else None
    return fit([t for _, t in sample], [label for label, _ in sample], prior)


def score(documents: DataFrame, model: Field, text: str = "text", threshold: float = 0.3, spans: bool = True) -> DataFrame:
    """documents plus ``score``, ``predicted`` and, if asked, ``toxic_spans``: (start, end, p) in code points."""
    df = documents.drop("score", "predicted", "toxic_spans")
    kept = df.schema.fields
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def work(batches):
        tagger = Tagger(model)
        for whole in batches:
            for at in range(0, whole.num_rows, DOCS_AT_ONCE):
                batch = whole.slice(at, DOCS_AT_ONCE)
                texts = [t or "" for t in batch.column(text).to_pylist()]
                post, n = tagger.run(texts)
                values = model.scores(post, n)
                made = {"score": pa.array(values), "predicted": pa.array((values >= threshold).astype(np.int32))}
                if spans:
                    made["toxic_spans"] = pa.array(offsets(texts, post, n), kind)
                yield pa.RecordBatch.from_pydict({f.name: batch.column(f.name) for f in kept} | made)

    had = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return df.mapInArrow(work, had + "score double, predicted int" + ", toxic_spans array<struct<start:bigint,end:bigint,p:double>>" * spans)


def offsets(texts: list[str], post: np.ndarray, n_docs: np.ndarray, least: float = 0.5) -> list[list[dict]]:
    """Neighbouring toxic tokens as one span, with the greatest marginal among them."""
    out, ends = [], np.cumsum(n_docs)
    for text, end, n in zip(texts, ends, n_docs, strict=True):
        p, found = post[end - n : end], []
        hot = np.flatnonzero(p >= least)
        if len(hot):
            places = [m.span() for m in re.finditer(r"\S+", text)] if not re.search("[\x1c-\x1f]", text) else _split_places(text)
            for k in hot:
                if found and found[-1][2] == k - 1:
                    found[-1] = (found[-1][0], places[k][1], k, max(found[-1][3], p[k]))
                else:
                    found.append((*places[k], k, p[k]))
        out.append([{"start": a, "end": b, "p": float(q)} for a, b, _, q in found])
    return out


def _split_places(text: str) -> list[tuple[int, int]]:
    places, at = [], 0
    for t in text.split():
        at = text.index(t, at)
        places.append((at, at + len(t)))
        at += len(t)
    return places


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model)
    return out.select("doc_id", F.expr(f"coalesce({HELD_OUT}, false)").alias("held_out"), "score", "predicted", F.size("toxic_spans").cast("long").alias("n_spans"))
