"""Periodic runs of words, proposed by string synchronising sets.

A run is a stretch of consecutive words whose smallest period q repeats at least ``POWER`` times (and that has at least
``LEAST`` words), and that cannot be extended on either side with period q.

At scale t (a power of two) a window of t words gets a hash, and place i is chosen if the least hash among the windows
that start at i .. i+t belongs to the first or to the last of them. The choice depends on the 2t words from i alone, so
equal stretches choose equal places. Windows of period at most t/4 are left out: they lie in runs that smaller scales
have found already, and choosing among their equal hashes would choose too many places. Of any t neighbouring places one
is chosen unless all windows around have such a small period. A run of period q in [t, 2t) with four periods therefore
holds a chosen place i and the chosen place i+q with the same 2t words, and no place between them has these words. So
each pair of neighbouring places of equal context at a distance in [t, 2t) proposes its distance, a proposal is extended
by comparing words, and the runs of all scales are all runs. Highly periodic regions of fewer than ``SMALL`` words a
period are found directly, by comparing the text with itself shifted.

Null and empty texts have no words and no runs. Rows are judged one by one: repeated rows and null ids give their own rows,
other columns are not read. A text is held by one task; texts are taken some thousand words at a time.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.llm.common import by_batch, slices
from postings.llm.hashing import mix

LEAST, POWER = 6, 4
#: Periods below this are found by shifting the text; a power of two.
SMALL = 8
_NONE = np.uint64(2**64 - 1)
_BASE = 0x5851F42D4C957F2D
RUN = "struct<start:bigint,length:bigint,period:bigint>"


class _Windows:
    """Hashes of windows of a sequence of numbers, by running sums."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self._down = np.ones(n + 1, np.uint64)
        self._down[1:] = np.uint64(pow(_BASE, -1, 2**64))
        np.multiply.accumulate(self._down, out=self._down)
        up = np.ones(n, np.uint64)
        up[1:] = np.uint64(_BASE)
        np.multiply.accumulate(up, out=up)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(ids.view(np.uint64), 3) * up, out=self._sums[1:])

    def every(self, size: int, end: int) -> np.ndarray:
        """Hashes of the windows of ``size`` numbers among the first ``end``."""
        return mix((self._sums[size:end + 1] - self._sums[:end + 1 - size]) * self._down[:end + 1 - size], 5)

    def at(self, start: np.ndarray, size: int) -> np.ndarray:
        return mix((self._sums[start + size] - self._sums[start]) * self._down[start], 5)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    blocks = -(-len(h) // width)
    padded = np.full(blocks * width, _NONE)
    padded[:len(h)] = h
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:len(h) - width + 1], ahead[width - 1:len(h)])


def _shifted(ids: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches [start, end) of period p that are long enough to be runs."""
    differ = np.concatenate(([-1], np.flatnonzero(ids[p:] != ids[:-p]), [len(ids) - p]))
    same = np.diff(differ) - 1
    long = np.flatnonzero(same + p >= max(LEAST, POWER * p))
    return differ[long] + 1, differ[long] + 1 + same[long] + p


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix of two arrays, compared in growing pieces."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at:at + step][:n - at] != b[at:at + step][:n - at]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, step * 2
    return n


def _chosen(windows: _Windows, t: int, end: int, runs: dict) -> np.ndarray:
    """The synchronising set of scale t among the first ``end`` numbers."""
    h = windows.every(t, end)
    edges = np.zeros(len(h) + 1, np.int64)
    for (s, e), p in runs.items():
        if 4 * p <= t <= e - s and s < len(h):
            edges[s] += 1
            edges[min(e - t + 1, len(h))] -= 1
    h[np.cumsum(edges[:-1]) > 0] = _NONE
    if len(h) <= t:
        return np.zeros(0, np.int64)
    least = _least(h, t + 1)
    return np.flatnonzero((least != _NONE) & ((least == h[:-t]) | (least == h[t:])))


def find_runs(ids: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], int]:
    """{(start, end): period} of all runs in ``ids``: texts one behind the other, longest first, a unique number behind
    each; ``ends`` are the places of those numbers."""
    runs: dict[tuple[int, int], int] = {}
    for p in range(1, min(SMALL, len(ids))):
        for s, e in zip(*(x.tolist() for x in _shifted(ids, p))):
            runs.setdefault((s, e), p)  # the smallest period of a stretch comes first
    lengths = np.diff(np.concatenate(([-1], ends))) - 1
    t = SMALL
    windows = _Windows(ids) if len(ids) else None
    while len(lengths) and lengths[0] >= POWER * t:
        end = int(ends[np.flatnonzero(lengths >= POWER * t)[-1]])
        at = _chosen(windows, t, end, runs)
        context = windows.at(at, 2 * t)
        order = np.argsort(context, kind="stable")
        at, context = at[order], context[order]
        gap = np.where(context[1:] == context[:-1], at[1:] - at[:-1], 0)
        fits = (gap >= t) & (gap < 2 * t)
        fits[1:] &= gap[1:] != gap[:-1]  # the pair before proposed the same
        for i, d in zip(at[:-1][fits].tolist(), gap[fits].tolist()):
            right = _agree(ids[i:], ids[i + d:])
            left = _agree(ids[:i][::-1], ids[:i + d][::-1])
            s, e = i - left, i + d + right
            if e - s >= POWER * d:
                runs.setdefault((s, e), d)
        t *= 2
    return runs


def _scan(batch: pa.RecordBatch):
    words = [(t or b"").split() for t in batch.column("text").to_pylist()]  # on bytes: the white space of the contract
    cycles = batch.column("cycle").to_pylist()
    for k, c in enumerate(cycles):
        w = words[k]
        if c and c["start"] is not None and c["period"] and c["start"] < len(w):
            a, p = c["start"], c["period"]
            once = w[a:a + p]
            words[k] = w[:a] + (once * (-(-(len(w) - a) // len(once))))[:len(w) - a]
    order = sorted(range(len(words)), key=lambda k: -len(words[k]))
    lengths = np.array([len(words[k]) for k in order], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    flat = pa.array([w for k in order for w in words[k]], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    ids = np.empty(len(flat) + len(ends), np.int64)
    inside = np.ones(len(ids), bool)
    inside[ends] = False
    ids[inside], ids[~inside] = flat, -1 - np.arange(len(ends))
    found: list[list[dict]] = [[] for _ in words]
    for (s, e), p in find_runs(ids, ends).items():
        k = int(np.searchsorted(ends, s, "right"))
        found[order[k]].append({"start": s - (int(ends[k - 1]) + 1 if k else 0), "length": e - s, "period": p})
    kept = []
    for w, runs in zip(words, found):
        runs.sort(key=lambda r: (r["start"], r["period"]))
        if runs:
            keep = np.ones(len(w), bool)
            for r in runs:
                keep[r["start"] + r["period"]:r["start"] + r["length"]] = False
            w = compress(w, keep)
        kept.append(b" ".join(w).decode())
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    columns = [batch.column("doc_id"), pa.array(map(len, words), pa.int64()), pa.array(found, kind), pa.array(kept, pa.string())]
    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def _in_slices(batch: pa.RecordBatch):
    for part in slices(batch, "text"):
        yield from _scan(part)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cycle: Column | None = None) -> DataFrame:
    """Per row: doc_id, ``n_words``, ``runs`` (start, length, period by start, then period) and ``collapsed``: the words,
    joined by one space, that no run holds behind its first period.

    ``cycle``, a struct of ``start`` and ``period``, says of a row that its words from ``start`` on are to be read as the
    ``period`` words there, over and over (null: as they are): cases planted to measure what is found.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    planted = F.lit(None) if cycle is None else cycle
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), planted.cast("struct<start:bigint,period:bigint>").alias("cycle"))
    return rows.mapInArrow(by_batch(_in_slices), f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """One row per text with the number of runs, the longest (ties: smallest start, then period) and hashes of all."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"), F.expr("(-1000 * best.l) div best.p").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
