"""SimHash near-duplicates found through deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Fingerprints that differ in at most two bits
agree in one segment up to one bit, so they share a variant of that segment with one position left
out: 64 variants per fingerprint, joined by equality and verified on all 64 bits. Rows equal in fingerprint
are one node from the start, however many there are.

Each task reads the variants of its signatures in order, with a window of ``run_limit`` rows. Members of
a longer run are not compared with each other. They go, by an exact way, through the 65 values within one
bit of each: two fingerprints within two bits of each other share such a value, and all that
share one are within two bits, so a group takes one link per member, never all pairs.

Null and empty texts have fingerprint zero and are linked like any other. Null ids stay in the result;
``component_id`` is null only if no row of the component has an id. Repeated rows give repeated rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.common import by_batch, stored
from postings.llm.graph import components

SHINGLE, SEED, MAX_BITS = 3, 42, 2
SEGMENTS, WIDTH = 2, 32
RUN_LIMIT = 32
#: Shingles of a text whose hashes are held at once.
CHUNK = 65_536


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """SimHash of the ``size``-word shingles of a UTF-8 text; a bit is set if more than half the hashes have it."""
    words = (text or b"").lower().split()  # on bytes: A-Z only, and the white space of the contract
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    last = max(1, len(words) - size + 1)
    ends = (starts + lengths)[min(size, len(words)) - 1:]
    one = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, last, CHUNK):
        spans = zip(starts[i:i + CHUNK].tolist(), ends[i:i + CHUNK].tolist())
        h = np.array([one(joined[a:b], SEED) for a, b in spans], ">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > last).tobytes(), "big")


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``fp`` (the fingerprint as a signed BIGINT)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batch: pa.RecordBatch):
        values = [fingerprint(t.as_py()) for t in batch.column(1)]
        fp = pa.array(np.array(values, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), fp], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(by_batch(scan), f"doc_id {kind}, fp bigint")


def _variants(batch: pa.RecordBatch):
    """One row per left-out position: (segment, position, other 31 bits) packed into ``sig``."""
    fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
    for start in range(0, len(fp), 4096):
        part = fp[start:start + 4096]
        sigs = []
        for segment in range(SEGMENTS):
            bits = (part >> np.uint64(segment * WIDTH)) & np.uint64(2**WIDTH - 1)
            for p in range(WIDTH):
                low = bits & np.uint64(2**p - 1)
                high = bits >> np.uint64(p + 1) << np.uint64(p)
                sigs.append(np.uint64((segment * WIDTH + p) << (WIDTH - 1)) | high | low)
        sig = np.concatenate(sigs).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(np.tile(part, len(sigs)).view(np.int64))], ["sig", "fp"])


def _links(limit: int):
    """From rows in order of ``sig``: verified links (u, v) inside short runs; (u, null) for members of long ones."""
    def resolve(sig: np.ndarray, fp: np.ndarray):
        starts = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        sizes = np.diff(np.append(starts, len(sig)))
        long = np.repeat(sizes > limit, sizes)
        u, v = [], []
        for gap in range(1, limit):
            a = np.flatnonzero((sig[:-gap] == sig[gap:]) & ~long[:-gap]) if gap < len(sig) else np.array([], int)
            if not len(a):
                break
            near = np.bitwise_count((fp[a] ^ fp[a + gap]).view(np.uint64)) <= MAX_BITS
            u.append(fp[a[near]])
            v.append(fp[a[near] + gap])
        lone = np.unique(fp[long])
        pairs = np.unique(np.stack([np.concatenate(u), np.concatenate(v)], 1), axis=0) if u else np.zeros((0, 2), np.int64)
        nodes = np.concatenate([pairs[:, 0], lone])
        other = pa.array(np.concatenate([pairs[:, 1], lone]), mask=np.arange(len(nodes)) >= len(pairs))
        if len(nodes):
            yield pa.RecordBatch.from_arrays([pa.array(nodes), other], ["u", "v"])

    def run(batches):
        sig, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            sig = np.concatenate([sig, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy()])
            cut = int(np.searchsorted(sig, sig[-1])) if len(sig) else 0  # the last run may go on
            if len(sig) - cut > limit:
                # A long run: its members can go now; as many stay as keep it recognisable.
                keep = limit + 1
                yield from resolve(sig, fp)
                sig, fp = sig[-keep:], fp[-keep:]
            else:
                if cut:
                    yield from resolve(sig[:cut], fp[:cut])
                sig, fp = sig[cut:], fp[cut:]
        if len(sig):
            yield from resolve(sig, fp)

    return run


def _ball_links(nodes: DataFrame) -> DataFrame:
    """Links among nodes through the values within one bit of each; a star per shared value."""
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(x).cast("bigint") for x in np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64)).view(np.int64).tolist()])
    near = nodes.select("u", F.explode(F.transform(flips, lambda m: F.col("u").bitwiseXOR(m))).alias("at"))
    stars = near.groupBy("at").agg(F.array_sort(F.collect_list("u")).alias("l")).filter(F.size("l") > 1)  # 65 members at most
    return stars.select(F.col("l")[0].alias("u"), F.explode(F.slice("l", F.lit(2), F.size("l") - 1)).alias("v"))


def near_links(fps: DataFrame, run_limit: int = RUN_LIMIT) -> DataFrame:
    """Links ``u, v`` that connect distinct fingerprints (``fp``) within two bits of each other."""
    sorted_variants = fps.mapInArrow(by_batch(_variants), "sig bigint, fp bigint").repartition("sig").sortWithinPartitions("sig")
    found = stored(sorted_variants.mapInArrow(_links(run_limit), "u bigint, v bigint"), "simhash-links")
    ball = _ball_links(found.filter("v IS NULL").select("u").distinct())
    return found.filter("v IS NOT NULL").unionAll(ball)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_limit: int = RUN_LIMIT) -> DataFrame:
    """Per row: doc_id, ``fingerprint`` (16 hex digits), ``component_id`` (least id among all that links reach)."""
    prints = stored(with_fingerprints(docs, id_col, text_col), "simhash-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-nodes")
    roots = components(near_links(nodes.select("fp"), run_limit))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = stored(placed.select("fp", "root").join(least, "root").select("fp", "component_id"), "simhash-named")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_limit: int = RUN_LIMIT) -> DataFrame:
    """One row of each group of near copies, with its own columns: the one with the least id (nulls last).

    A row is known by its id and a hash of its text; rows equal in both are one document.
    """
    mark = F.xxhash64(F.lit(""), F.col(text_col))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    prints = stored(with_fingerprints(docs.withColumn("simhash_row", F.struct(F.col(id_col).alias("id"), key.alias("key"), mark.alias("mark"))), "simhash_row", text_col), "simhash-prints")
    order = F.struct(F.col("doc_id.id").isNull(), F.col("doc_id.id"), F.col("doc_id.mark"), F.col("doc_id.key"))
    nodes = stored(prints.groupBy("fp").agg(F.min(order).alias("best")), "simhash-nodes")
    roots = components(near_links(nodes.select("fp"), run_limit))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    best = placed.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("b"))
    chosen = best.select(F.col("b.key").alias("simhash_key"), F.col("b.mark").alias("simhash_mark"))
    # The rows travel as one struct, so that no column of theirs meets a helper's.
    keyed = docs.select(F.struct(*docs.columns).alias("row"), key.alias("simhash_key"), mark.alias("simhash_mark"))
    both = ["simhash_key", "simhash_mark"]
    return keyed.join(chosen, both, "left_semi").dropDuplicates(both).select(*[F.col("row")[c].alias(c) for c in docs.columns])
