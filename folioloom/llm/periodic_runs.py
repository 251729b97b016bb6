"""Runs of words that repeat with a period, found by counting matches per lag.

A run is a stretch of consecutive words with smallest period q, of at least max(6, 4 q) words,
that no neighbouring word extends keeping period q.  For each lag the number of words equal to
the word that many places on is counted exactly: words that are frequent in their text by the
autocorrelation of their places (one FFT a word, one inverse for all of them), rare ones by the
differences of their places.  Only a lag with as many matches as its shortest run needs is
scanned for islands of matches.  Larger lags are first looked at in steps of the lag: an island
of 3 q matches holds three such places in a row, and three that lie wholly inside a run of a
smaller period are no run of this one (their periods would agree).

A text is one task's work and a batch holds few texts, so a table's rows are dealt as they lie:
no shuffle, and no group.  Memory follows the longest single text.

Defined cases: a null or empty text has no words, no runs, and the digests of the empty string;
null ids, repeated rows and further columns pass through; a column with the name of an added
one is replaced; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folioloom.llm.merkle import CRC_OF, CRC_TABLE
from folioloom.llm.names import put_back, set_apart

EXPONENT, LEAST = 4, 6
#: Lags up to this are scanned at once; larger ones are looked at in steps first.
SHORT = 16


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def numbered(words: list) -> np.ndarray:
    """Equal words get equal numbers."""
    seen: dict = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def need(q: np.ndarray | int) -> np.ndarray | int:
    """Matches at lag q that the shortest run of period q has."""
    return np.maximum(LEAST, EXPONENT * q) - q


def lag_counts(ids: np.ndarray, heavy_from: float | None = None) -> np.ndarray:
    """counts[q]: places i with ids[i] == ids[i + q], for q up to a quarter of the text (exact)."""
    n = len(ids)
    top = n // EXPONENT
    counts = np.zeros(top + 1, np.int64)
    if not top:
        return counts
    order = np.argsort(ids, kind="stable")
    freq = np.bincount(ids)
    if heavy_from is None:
        heavy_from = max(64.0, float(np.sqrt(n * np.log2(n + 1))))
    heavy = np.flatnonzero(freq > heavy_from)
    if len(heavy):
        size = 1 << int(n + top).bit_length()
        power = np.zeros(size // 2 + 1)
        for w in heavy:
            f = np.fft.rfft((ids == w).astype(np.float64), size)
            power += f.real**2 + f.imag**2
        counts += np.rint(np.fft.irfft(power, size)[: top + 1]).astype(np.int64)
        order = order[freq[ids[order]] <= heavy_from]
    word, k = ids[order], 1
    while len(order) > k:
        same = word[k:] == word[:-k]
        if not same.any():
            break
        lag = (order[k:] - order[:-k])[same]
        counts += np.bincount(lag[lag <= top], minlength=top + 1)
        k += 1
    counts[0] = 0
    return counts


def _islands(match: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(first, number) of stretches of at least ``least`` true values."""
    if match.all():
        return [(0, len(match))] if len(match) >= least else []
    edge = np.flatnonzero(np.diff(match))
    first = np.concatenate(([0], edge + 1))
    size = np.diff(np.concatenate((first, [len(match)])))
    keep = match[first] & (size >= least)
    return list(zip(first[keep].tolist(), size[keep].tolist(), strict=True))


def _extent(ids: np.ndarray, q: int, at: int) -> tuple[int, int]:
    """First and last place of the island of matches at lag q around ``at``."""
    lo, step = at, 64
    while lo > 0:
        begin = max(0, lo - step)
        bad = np.flatnonzero(ids[begin:lo] != ids[begin + q : lo + q])
        if len(bad):
            lo = begin + int(bad[-1]) + 1
            break
        lo, step = begin, step * 2
    hi, step, end = at, 64, len(ids) - q
    while hi + 1 < end:
        stop = min(end, hi + 1 + step)
        bad = np.flatnonzero(ids[hi + 1 : stop] != ids[hi + 1 + q : stop + q])
        if len(bad):
            hi += int(bad[0])
            break
        hi, step = stop - 1, step * 2
    return lo, hi


def _far_islands(ids: np.ndarray, q: int, wide: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """As _islands at a large lag, without islands inside ``wide``, the runs of smaller periods."""
    at = np.arange(0, len(ids) - q, q)
    hit = ids[at] == ids[at + q]
    triples = at[:-2][hit[:-2] & hit[1:-1] & hit[2:]]
    if len(triples) and wide:
        first = np.array(sorted((s, s + length) for s, length, _ in wide), np.int64)
        reach = np.concatenate(([0], np.maximum.accumulate(first[:, 1])))
        triples = triples[triples + 3 * q > reach[np.searchsorted(first[:, 0], triples, "right")]]
    for part in (2, 3, 4, 5, 7):
        between = triples + q // part
        triples = triples[ids[between] == ids[between + q]] if len(triples) else triples
    found, done = [], -1
    for t in triples.tolist():
        if t <= done:
            continue
        if (ids[t : t + 2 * q] == ids[t + q : t + 3 * q]).all():
            lo, hi = _extent(ids, q, t)
            done = hi
            if hi - lo + 1 >= need(q):
                found.append((lo, hi - lo + 1))
    return found


def _primes(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] * (q > 1)


def find_runs(ids: np.ndarray, heavy_from: float | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if len(ids) < LEAST:
        return []
    counts = lag_counts(ids, heavy_from)
    lags = np.arange(len(counts))
    runs: list[tuple[int, int, int]] = []
    wide: list[tuple[int, int, int]] = []
    for q in lags[1:][counts[1:] >= need(lags[1:])].tolist():
        wide = [r for r in wide if r[1] >= 3 * q]
        islands = _islands(ids[:-q] == ids[q:], int(need(q))) if q <= SHORT else _far_islands(ids, q, wide)
        new = [(s, m + q, q) for s, m in islands if not any((ids[s : s + q] == ids[s + q // p : s + q // p + q]).all() for p in _primes(q))]
        runs += new
        wide += new
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for words that stay: those in no run, or only in the first period of their runs."""
    edge = np.zeros(n + 1, np.int64)
    for s, length, q in runs:
        edge[s + q] += 1
        edge[s + length] -= 1
    return np.cumsum(edge)[:n] == 0


def best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equal ones that of the least start, then period."""
    top = None
    for s, length, q in runs:  # exact: a / b > c / d by products
        if top is None or (x := length * top[2] - top[1] * q) > 0 or x == 0 and (s, q) < (top[0], top[2]):
            top = (s, length, q)
    return top


def planted(n: int, doc_id: int | None) -> np.ndarray:
    """Original place of each of ``n`` words after the change that a tenth of the ids brings."""
    at = np.arange(n)
    if doc_id is None or not n:
        return at
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return at
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at[a:] = a + (at[a:] - a) % p
    return at


SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
DIGEST = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _mapped(documents: DataFrame, schema: str, made, dropped: tuple[str, ...] = ()) -> DataFrame:
    """documents (without ``dropped``) plus what ``made(row values by column) -> tuple`` gives, batch by batch."""
    names = [c.split()[0] for c in schema.split(", ")]
    documents, back = set_apart(documents.drop(*[c for c in documents.columns if c in names]))
    kept = [f for f in documents.schema.fields if f.name not in dropped]
    types = documents.sparkSession.createDataFrame([], schema).schema

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        fields = [(f.name, to_arrow_type(f.dataType)) for f in types]
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                rows = [made(*v) for v in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)]
                new = {name: pa.array([r[i] for r in rows], t) for i, (name, t) in enumerate(fields)}
                yield pa.RecordBatch.from_pydict({f.name: part.column(f.name) for f in kept} | new)

    had = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return put_back(documents.mapInArrow(work, had + schema), back)


def _analysed(words: list[bytes]):
    ids = numbered(words)
    runs = find_runs(ids)
    return runs, [words[k] for k in np.flatnonzero(collapsed(len(words), runs))] if runs else words


def periodic_runs(documents: DataFrame) -> DataFrame:
    """documents (doc_id, text, ...) plus n_words, ``runs`` and ``collapsed``: the text without repeated periods."""

    def made(_, text):
        words = words_of(text)
        runs, kept = _analysed(words)
        shown = [{"start": s, "length": m, "period": q} for s, m, q in runs]
        return len(words), shown, b" ".join(kept).decode("utf-8", "replace")

    return _mapped(documents, SCHEMA, made)


def digests(documents: DataFrame) -> DataFrame:
    """documents without their text plus the digest columns, of texts with planted repeats."""

    def made(doc_id, text):
        words = words_of(text)
        words = [words[k] for k in planted(len(words), doc_id)]
        runs, kept = _analysed(words)
        told = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        top = best(runs)
        four = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        return len(runs), *four, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()

    return _mapped(documents, DIGEST, made, ("text",))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP12_SQL = rf"""
WITH {CRC_TABLE},
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             coalesce({CRC_OF.format(s="CAST(doc_id AS VARCHAR)")}, 1) AS h FROM documents, crc_bytes),
e AS (SELECT rid, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS changed, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, (h // 10) % 8 AS r FROM d),
t AS (SELECT rid, n, i, w[1 + CASE WHEN changed AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + r)) ELSE i END] AS x
      FROM (SELECT *, unnest(range(n)) AS i FROM e)),
m AS (SELECT p.rid, p.i, o.i - p.i AS q FROM t p JOIN t o ON p.rid = o.rid AND p.x = o.x AND o.i > p.i AND o.i - p.i <= p.n // 4),
c AS (SELECT rid, q FROM m GROUP BY rid, q HAVING count(*) >= greatest(6, 4 * q) - q),
isle AS (SELECT rid, q, min(i) AS s, count(*) + q AS m FROM (
           SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM m SEMI JOIN c USING (rid, q))
         GROUP BY rid, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT * FROM isle x WHERE NOT EXISTS (SELECT 1 FROM isle y WHERE y.rid = x.rid AND y.q < x.q AND y.s <= x.s AND y.s + y.m >= x.s + x.m)),
told AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM run GROUP BY rid),
top AS (SELECT rid, s, m, q FROM run QUALIFY row_number() OVER (PARTITION BY rid ORDER BY CAST(m AS DECIMAL(38, 20)) / q DESC, s, q) = 1),
gone AS (SELECT DISTINCT rid, unnest(range(s + q, s + m)) AS i FROM run),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY i) AS words FROM t ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(s AS BIGINT) AS start, CAST(m AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
       CAST(1000 * m // q AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM e LEFT JOIN told USING (rid) LEFT JOIN top USING (rid) LEFT JOIN kept USING (rid)
"""
