"""Spelling variants of the words of a corpus, found by asymmetric chunks.

A word of l code points is cut into two disjoint chunks, its first half and the rest. One inserted, deleted or replaced
code point leaves one of them whole: the first at the same place, the second at the same place or moved by one. So a word
writes its two chunks, and every word, as the possibly longer partner of words of l = its own length or one less, writes
those of its positional grams that can be such a chunk: of all places within one, the equal length of the remainder leaves
a single one. Both are joined by equality (as hashes, with l and the place), and what is left open between the common ends
is compared exactly: two words of equal length must agree once one place is left out, and the longer of two must equal
the other once one of its code points is left out. That is done through tables of the open parts with a place left out, so
a bucket costs what its members' open parts are long, never all pairs.

A bucket of more than ``BUCKET`` words is not read by one task: its members cut their open part in two again and are dealt
anew, until at most one code point is open. Such a last bucket holds no more words than there are letters, or pairs of
letters. The cut is exact: a pair passes through the first of the two chunks that it has in common.

Null and empty texts have no words. Repeated rows count as often as they stand; a null id is an empty one. Ties of n go to
the smallest word in code-point order. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.llm.common import slices, stored

LETTERS = "a-zÀ-ÿ"  # after lower-casing A-Z: a fixed value of the contract
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
BUCKET = 1024
#: Words counted in a task before they are handed on; code points searched at once.
HELD, STEP = 200_000, 1 << 20


def _runs(text: str, least: int):
    """Lists of the letter runs of a text, some of it at a time."""
    pattern, other = re.compile(f"[{LETTERS}]{{{least},}}"), re.compile(f"[^{LETTERS}]")
    start = 0
    while start < len(text):
        stop = other.search(text, start + STEP)
        end = stop.start() if stop else len(text)
        yield pattern.findall(text, start, end)
        start = end


def _counter(least: int, slip: int | None):
    def add(tally: Counter, key: str, text: bytes) -> None:
        seed = crc32(f"{key}:".encode())
        for words in _runs(text.lower().decode(), least):  # on bytes: A-Z only
            tally.update(words)
            if slip:
                for w, h in [(w, h) for w in words if (h := crc32(w.encode(), seed)) % slip == 0]:
                    tally[w] -= 1
                    if len(w) > least:
                        at = h % len(w)
                        tally[w[:at] + w[at + 1:]] += 1

    def flush(tally: Counter) -> pa.RecordBatch:
        some = [(w, n) for w, n in tally.items() if n]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], ["word", "n"])

    def run(batches):
        tally: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for key, text in zip(part.column("key").to_pylist(), part.column("text").to_pylist()):
                    add(tally, key, text)
                if len(tally) >= HELD:
                    yield flush(tally)
                    tally.clear()
        yield flush(tally)

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT, slip: int | None = None) -> DataFrame:
    """``word, n`` of all words that are long and frequent enough.

    ``slip``: an occurrence whose hash of id and word it divides loses one code point (cases planted to measure what is found).
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    parts = rows.mapInArrow(_counter(least_length, slip), "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _cut(rows: DataFrame) -> DataFrame:
    """Two rows for each: its open part less the first chunk, and less the second.

    ``a`` and ``b`` code points at the ends are settled, ``longer`` words have one code point more than ``l``. A pair
    whose first ``passed`` code points agree is found through another chunk.
    """
    l = F.char_length("word") - F.col("longer")
    opened = l - F.col("a") - F.col("b")
    half = F.floor(opened / 2).cast("int")
    both = F.array(
        F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("passed").alias("passed")),
        F.struct(F.col("a").alias("a"), (F.col("b") + opened - half).alias("b"), (F.col("a") + half).alias("passed")))
    cut = rows.select("word", "n", "longer", l.alias("l"), F.inline(both))
    ends = F.substring("word", F.lit(1), F.col("a")), F.substring("word", F.char_length("word") - F.col("b") + 1, F.col("b"))
    return cut.select(F.xxhash64("l", "a", "b", *ends).alias("chunk"), "word", "n", "longer", "a", "b", "passed")


def _near(words: list[str], a: int, b: int, passed: int, longer: list[int]) -> set[tuple[int, int]]:
    """Pairs of places of words that differ by one edit between the settled ends."""
    shorter: dict[str, int] = {}
    gaps: dict[tuple[int, str], list[int]] = {}
    pairs = set()
    for k, w in enumerate(words):
        if not longer[k]:
            mid = w[a:len(w) - b]
            shorter[mid] = k
            for i in range(len(mid)):
                gaps.setdefault((i, mid[:i] + mid[i + 1:]), []).append(k)
    for same in gaps.values():
        pairs.update((x, y) for n, x in enumerate(same) for y in same[:n])
    for k, w in enumerate(words):
        if longer[k]:
            mid = w[a:len(w) - b]
            for i in range(len(mid)):
                x = shorter.get(mid[:i] + mid[i + 1:])
                if x is not None:
                    pairs.add((x, k))
    return {(x, y) for x, y in pairs if not passed or words[x][:passed] != words[y][:passed]}


def _links(batches):
    """From rows in order of ``chunk``: each pair of near words, both ways."""
    def resolve(run: list[tuple]):
        groups: dict[tuple, list[tuple]] = {}
        for _, word, n, longer, a, b, passed in run:  # one group but for hashes that collide
            groups.setdefault((a, b, passed, len(word) - longer), []).append((word, n, longer))
        for (a, b, passed, _), members in groups.items():
            words, counts, longer = zip(*members)
            for x, y in _near(words, a, b, passed, longer):
                yield words[x], words[y], counts[y]
                yield words[y], words[x], counts[x]

    def emit(links: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*links), kinds)], ["word", "other", "other_n"])

    run: list[tuple] = []
    links: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if run and run[-1][0] != row[0]:
                if len(run) > 1:
                    links.extend(resolve(run))
                run = []
                if len(links) >= 50_000:
                    yield emit(links)
                    links = []
            run.append(row)
    links.extend(resolve(run))
    if links:
        yield emit(links)


def near_words(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``word, other, other_n`` for all ordered pairs of distinct words (``word, n``) one edit apart."""
    zero = F.lit(0)
    start = words.select("word", F.col("n"), F.explode(F.array(zero, F.lit(1))).alias("longer"), zero.alias("a"), zero.alias("b"), zero.alias("passed"))
    rows, found = stored(_cut(start), "spelling-chunks"), None
    while True:
        # Buckets that are too large and still open; at most one row per ``bucket`` rows.
        opened = F.char_length("word") - F.col("longer") - F.col("a") - F.col("b")
        large = stored(rows.filter(opened > 1).groupBy("chunk").count().filter(F.col("count") > bucket).select("chunk"), "spelling-large")
        last = large.isEmpty()
        whole = rows if last else rows.join(large, "chunk", "left_anti")
        order = ["chunk", "word", "n", "longer", "a", "b", "passed"]
        links = whole.select(*order).repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_links, "word string, other string, other_n bigint")
        found = links if found is None else found.unionAll(links)
        if last:
            return found
        rows = stored(_cut(rows.join(large, "chunk", "left_semi")), "spelling-chunks")


def follow(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form`` (both non-null, without cycles): the last word that forms lead to."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(now.join(ahead, "root", "left"), "spelling-roots")
        now = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.filter("next IS NOT NULL").isEmpty():
            return now


def group_spellings(words: DataFrame, ratio: int = RATIO, bucket: int = BUCKET) -> DataFrame:
    """Per word (``word, n``, words distinct): ``form``, the near word of largest n if that is ``ratio`` times its own;
    ``form_n``; ``root``, where forms lead; ``n_near``, the number of near words."""
    words = stored(words.select("word", "n"), "spelling-words")
    near = near_words(words, bucket).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    takes: Column = -F.col("best.less") >= ratio * F.col("n")
    named = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(takes, F.col("best.other")).alias("form"), F.when(takes, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = follow(named.filter("form IS NOT NULL"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
