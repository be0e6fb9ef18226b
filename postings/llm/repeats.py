"""Removal of long repeats through a sparse suffix array, sorted by a distributed merge of front-coded runs.

Every byte covered by a string of ``LENGTH`` bytes that starts anywhere else too is removed. Sorting all suffixes would
exchange many times the input, so the suffix array is sparse: each window of ``LENGTH`` bytes names one anchor
inside it, the place of the least k-mer hash in its middle. Equal windows name the same place, with at least
``MARGIN`` bytes on both sides, so windows repeat only if their anchors share that context:

1. A hash of every anchor's context is shuffled; anchors whose context is unique are done (the sort's duplicate detection).
2. Tasks sort the suffixes of the remaining anchors, cut at the end of their last window, and exchange them as
   front-coded runs: length of the common prefix with the one before, and the rest. Contexts decide the partition.
3. Each partition merges its runs with a loser tree over common-prefix lengths, which compares characters beyond known
   prefixes only. Neighbours with the whole context in common form a group; within it windows are compared as bytes of
   equal digest. A suffix with all its windows seen twice is settled at once, and only one copy of it is held.
4. A group of more than ``GROUP_LIMIT`` different suffixes is not held as a whole: it is settled ``GROUP_LIMIT`` suffixes at a
   time, and each part's different windows, one row each, go through one more shuffle by digest.

Windows are judged on the input, overlap freely and never cross documents. Digests have 128 bits. Null and empty texts
have no bytes. Repeated rows, ids included, are copies of each other. Null ids stay.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.common import stored
from postings.llm.hashing import Stretches

LENGTH, KMER, MARGIN = 200, 8, 40
#: Different suffixes of one group held at once; bytes of text looked at together; bytes of suffixes sorted per run.
GROUP_LIMIT, BLOCK, RUN_BYTES = 2000, 1 << 20, 24 << 20


# ---- anchors -------------------------------------------------------------------------------


def anchors(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int = LENGTH, margin: int = MARGIN):
    """Of texts within ``data``: (anchor, first window, last window, context hash), places counted from the block's start."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    width = length - 2 * margin - KMER + 1
    if not len(sizes) or sizes.max() < length:
        return none
    hashes = Stretches(data)
    # The place in the low bits: ties go to the leftmost, and the least value tells where it is.
    values = hashes.every(KMER, 2) >> np.uint64(24) << np.uint64(24) | np.arange(len(data) - KMER + 1, dtype=np.uint64)
    least, size = values[margin:], 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:len(least) - (width - size)], least[width - size:])
    most = np.maximum(sizes - length + 1, 0)
    windows = np.repeat(starts - (np.cumsum(most) - most), most) + np.arange(most.sum())
    place = (least[windows] & np.uint64(2**24 - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.concatenate((first[1:], [len(place)])) - 1
    at = place[first]
    return at, windows[first], windows[last], hashes.of(at - margin, at + KMER + margin, 3)


def blocks(texts: Iterator[tuple[int, bytes]], length: int = LENGTH, most: int = BLOCK):
    """(rows, offsets in their text, starts in the block, sizes, bytes): texts laid together, long ones cut so
    that each window lies in one piece."""
    rows, offsets, pieces, size = [], [], [], 0
    for row, text in texts:
        for at in range(0, max(1, len(text) - length + 1), most):
            piece = text[at:at + most + length - 1]
            rows.append(row)
            offsets.append(at)
            pieces.append(piece)
            size += len(piece)
            if size >= most:
                yield _block(rows, offsets, pieces)
                rows, offsets, pieces, size = [], [], [], 0
    if rows:
        yield _block(rows, offsets, pieces)


def _block(rows: list, offsets: list, pieces: list):
    sizes = np.array([len(p) for p in pieces], np.int64)
    return np.array(rows), np.array(offsets, np.int64), np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(pieces), np.uint8)


def _find_anchors(batches):
    """context, k1, at: place of the anchor and the distances to its first and from its first to its last window, packed."""
    for batch in batches:
        k1 = batch.column(0).to_numpy()
        texts = ((i, t.as_py() or b"") for i, t in enumerate(batch.column(1)))
        for rows, offsets, starts, sizes, data in blocks(texts):
            at, first, last, context = anchors(data, starts, sizes)
            if len(at):
                piece = np.searchsorted(starts, at, "right") - 1
                place = at - starts[piece] + offsets[piece]
                packed = place << 16 | (at - first) << 8 | (last - first)
                yield pa.RecordBatch.from_arrays([pa.array(context.view(np.int64)), pa.array(k1[rows[piece]]), pa.array(packed)], ["context", "k1", "at"])


def _shared_runs(batches):
    """From rows in order of their first column: those whose value occurs twice or more, without it."""
    held = None  # the last row, and whether its value was seen before
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        if not len(columns[0]):
            continue
        again = held[1] if held else False
        if held:
            columns = [np.concatenate([h, c]) for h, c in zip(held[0], columns)]
        key = columns[0]
        same = key[1:] == key[:-1]
        shared = np.concatenate(([again], same)) | np.concatenate((same, [False]))
        out = shared[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(c[:-1][out]) for c in columns[1:]], batch.schema.names[1:])
        held = [c[-1:] for c in columns], bool(shared[-1])
    if held and held[1]:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0][1:]], batch.schema.names[1:])


# ---- sorted runs ---------------------------------------------------------------------------


def common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings that agree up to ``start``."""
    n = min(len(a), len(b))
    x, y = a[start:n], b[start:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (differ.bit_length() + 7) // 8


def encode_run(entries: list[tuple[bytes, bytes, int, int, int]]) -> list[bytes]:
    """Front-coded columns of entries (suffix, left part, k1, k2, at), sorted here."""
    entries.sort()
    shared, tails, before = [], [], b""
    for suffix, *_ in entries:
        n = common(before, suffix, 0)
        shared.append(n)
        tails.append(suffix[n:])
        before = suffix
    pack = zstandard.ZstdCompressor(3).compress
    return [
        np.array(shared, np.uint16).tobytes(), np.array([len(t) for t in tails], np.uint16).tobytes(), pack(b"".join(tails)),
        np.array([len(e[1]) for e in entries], np.uint8).tobytes(), pack(b"".join(e[1] for e in entries)),
        np.array([e[2] for e in entries], np.int64).tobytes(), np.array([e[3] for e in entries], np.int32).tobytes(), np.array([e[4] for e in entries], np.int64).tobytes(),
    ]


def decode_run(columns: list[bytes]) -> Iterator[tuple[int, bytes, tuple]]:
    """(prefix shared with the entry before, suffix, (left part, k1, k2, at)) in order."""
    unpack = zstandard.ZstdDecompressor().decompress
    shared, sizes = np.frombuffer(columns[0], np.uint16).tolist(), np.frombuffer(columns[1], np.uint16).tolist()
    tails, lefts = unpack(columns[2]), unpack(columns[4])
    rest = zip(np.frombuffer(columns[3], np.uint8).tolist(), *(np.frombuffer(c, t).tolist() for c, t in zip(columns[5:], (np.int64, np.int32, np.int64))))
    at, left_at, before = 0, 0, b""
    for n, size, (left_size, *payload) in zip(shared, sizes, rest):
        before = before[:n] + tails[at:at + size]
        at += size
        yield n, before, (lefts[left_at:left_at + left_size], *payload)
        left_at += left_size


def merge_runs(runs: list[Iterator[tuple[int, bytes, tuple]]]) -> Iterator[tuple[int, bytes, tuple]]:
    """Merge sorted runs with a loser tree; each entry comes with its common prefix with the one before it.

    Contenders carry their common prefix with the last winner. The longer one is the smaller string; only
    equal ones are compared, from there on, and the loser keeps what they have in common.
    """
    width = 1
    while width < len(runs):
        width *= 2
    heads: list = [next(r, None) for r in runs] + [None] * (width - len(runs))
    known = [0] * width
    loser = [0] * width

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        s, t = x[1], y[1]
        n = common(s, t, known[a])
        if n == len(s) or (n < len(t) and s[n] < t[n]):
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    def build(node: int) -> int:
        if node >= width:
            return node - width
        winner, loser[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    best = build(1) if width > 1 else 0
    while heads[best] is not None:
        _, suffix, payload = heads[best]
        yield known[best], suffix, payload
        head = heads[best] = next(runs[best], None)
        known[best] = head[0] if head else 0
        node = (best + width) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2


_RUN = "part int, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary, c5 binary, c6 binary, c7 binary"


def _sorted_runs(parts: int, context: int):
    """Runs of the suffixes of listed anchors, one row per part and block. Rows: k1, k2, text, anchors."""
    def run(batches):
        held, size = [[] for _ in range(parts)], 0

        def flush():
            for part, entries in enumerate(held):
                if entries:
                    columns = encode_run(entries)
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *[pa.array([c], pa.binary()) for c in columns]], ["part", *[f"c{i}" for i in range(8)]])
                    entries.clear()

        for batch in batches:
            for k1, k2, raw, places in zip(*batch.columns):
                text, k1, k2 = raw.as_py(), k1.as_py(), k2.as_py()
                for packed in places.as_py():
                    at, to_first, span = packed >> 16, packed >> 8 & 255, packed & 255
                    first, left_end = at - to_first, at - MARGIN
                    suffix = text[left_end:first + span + LENGTH]
                    held[xxhash.xxh32_intdigest(suffix[:context]) % parts].append((suffix, text[first:left_end], k1, k2, first))
                    size += len(suffix) + 300
                if size > RUN_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def _settle(members: dict[tuple[bytes, bytes], list], counts: Counter):
    """Runs of repeated windows of the suffixes of a group seen once."""
    for (suffix, left), (n, k1, k2, first) in members.items():
        if n == 1:
            whole = left + suffix
            hits = [counts[xxhash.xxh3_128_digest(whole[i:i + LENGTH])] > 1 for i in range(len(whole) - LENGTH + 1)]
            begin = None
            for i, hit in enumerate([*hits, False]):
                if hit and begin is None:
                    begin = i
                elif not hit and begin is not None:
                    yield k1, k2, first + begin, first + i - 1
                    begin = None


_FOUND = "k1 bigint, k2 int, first bigint, last bigint, d1 bigint, d2 bigint, weight int"


def repeated(entries: Iterator[tuple[int, bytes, tuple]], context: int, limit: int = GROUP_LIMIT) -> Iterator[tuple]:
    """Rows of ``_FOUND``: windows first to last repeat (no digest), or a window whose digest is to be counted elsewhere (its
    owner is known to repeat already where that is null)."""
    members: dict[tuple[bytes, bytes], list] = {}
    wide = False

    def spread(counts):
        """What others must know: per different window one row, with its owner if it was seen once so far."""
        for (suffix, left), (n, k1, k2, first) in members.items():
            whole = left + suffix
            for i in range(len(whole) - LENGTH + 1):
                d = xxhash.xxh3_128_digest(whole[i:i + LENGTH])
                seen = counts.pop(d, 0)
                if seen:
                    owner = (k1, k2, first + i, first + i) if seen == 1 else (None, None, None, None)
                    yield (*owner, *np.frombuffer(d, ">i8").tolist(), min(seen, 2))

    def close():
        if wide or len(members) > 1:
            counts: Counter = Counter()
            for (suffix, left), entry in members.items():
                whole = left + suffix
                for i in range(len(whole) - LENGTH + 1):
                    counts[xxhash.xxh3_128_digest(whole[i:i + LENGTH])] += entry[0]
            for row in _settle(members, counts):
                yield (*row, None, None, None)
            if wide:
                yield from spread(counts)
        members.clear()

    for shared, suffix, (left, k1, k2, first) in entries:
        if shared < context:
            yield from close()
            wide = False
        key = (suffix, left)
        entry = members.get(key)
        last = first + len(left) + len(suffix) - LENGTH
        if entry is None:
            members[key] = [1, k1, k2, first]
            if len(members) > limit:
                wide = True
                # The one at hand may occur again; the others of this context leave as windows.
                own = members.pop(key)
                yield from close()
                members[key] = own
        else:
            if entry[0] == 1:
                yield entry[1], entry[2], entry[3], entry[3] + len(left) + len(suffix) - LENGTH, None, None, None
            entry[0] = 2
            yield k1, k2, first, last, None, None, None
    yield from close()


def _merge(context: int, limit: int):
    names = ["k1", "k2", "first", "last", "d1", "d2", "weight"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def run(batches):
        runs = [[c[i].as_py() for c in batch.columns[1:]] for batch in batches for i in range(batch.num_rows)]
        held = []
        for row in repeated(merge_runs([decode_run(r) for r in runs]), context, limit):
            held.append(row)
            if len(held) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    return run


def _counted(found: DataFrame) -> DataFrame:
    """Windows that left their group with an owner, and were seen elsewhere too, by digest."""
    far = found.filter("weight IS NOT NULL")
    total = far.groupBy("d1", "d2").agg(F.sum("weight").alias("n")).filter("n > 1").select("d1", "d2")
    return far.filter("k1 IS NOT NULL").join(total, ["d1", "d2"], "left_semi").select("k1", "k2", "first", "last")


# ---- the operator --------------------------------------------------------------------------


def repeated_windows(rows: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """k1, k2, spans: windows (first, last) that repeat. ``rows``: k1, k2, text (binary)."""
    context = KMER + 2 * MARGIN
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = rows.select("k1", "text").mapInArrow(_find_anchors, "context bigint, k1 bigint, at bigint")
    shared = every.repartition("context").sortWithinPartitions("context").mapInArrow(_shared_runs, "k1 bigint, at bigint")
    # Rows equal in id and text share k1: each of their anchors is listed once, and both rows read it.
    listed = stored(shared.distinct().groupBy("k1").agg(F.collect_list("at").alias("places")), "repeat-anchors")
    runs = rows.join(listed, "k1").select("k1", "k2", "text", "places").mapInArrow(_sorted_runs(parts, context), _RUN)
    found = stored(runs.repartition(parts, "part").mapInArrow(_merge(context, group_limit), _FOUND), "repeat-windows")
    windows = found.filter("weight IS NULL").select("k1", "k2", "first", "last").unionAll(_counted(found))
    return windows.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept``, the bytes that stay."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("k1"), F.hash(text, F.col(id_col)).alias("k2"), text.cast("binary").alias("text"))
    spans = repeated_windows(rows.select("k1", "k2", "text"), group_limit)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                out = [_kept(t.as_py(), s.as_py()) for t, s in zip(part.column(1), part.column(2))]
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = rows.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def _kept(text: bytes, spans: list | None) -> tuple[int, int, int, str, bytes]:
    parts, at, runs, removed = [], 0, 0, 0
    begin = end = -1
    for span in sorted((s["first"], s["last"] + LENGTH) for s in spans or ()):
        if span[0] > end:
            if end >= 0:
                parts.append(text[at:begin])
                removed += end - begin
                at = end
            begin, runs = span[0], runs + 1
        end = max(end, span[1])
    if end >= 0:
        parts.append(text[at:begin])
        removed += end - begin
        at = end
    kept = b"".join([*parts, text[at:]])
    return len(text), removed, runs, hashlib.sha256(kept).hexdigest(), kept
