import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from postings.llm import periodic, queries
from tests.llm.test_pieces import table


def brute_runs(words):
    """{(start, end): smallest period} by trying all periods and all places."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return found


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = sorted((s, e - s, q) for (s, e), q in brute_runs(words).items())
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), kept)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, runs and 1000 * best[1] // best[2] or None, *sha)


def repeats(rnd):
    words = []
    for _ in range(rnd.randint(0, 4)):
        letters = rnd.choice([1, 2, 3, 50])
        block = [rnd.randint(1, letters) for _ in range(rnd.choice([1, 2, 5, 8, 9, 13, 17, 30, 40]))]
        if rnd.random() < 0.4:
            block = (block[:rnd.randint(1, 4)] * 40)[:len(block)] + [99] * rnd.randint(0, 1)
        words += (block * rnd.randint(1, 9))[:rnd.randint(1, 400)]
    return words


def test_find_runs_matches_all_periods():
    rnd = random.Random(3)
    for _ in range(400):
        texts = sorted((repeats(rnd) for _ in range(rnd.randint(1, 4))), key=len, reverse=True)
        ids, ends, want = [], [], {}
        for k, words in enumerate(texts):
            want |= {(s + len(ids), e + len(ids)): q for (s, e), q in brute_runs(words).items()}
            ends.append(len(ids) + len(words))
            ids += [*words, -1 - k]
        assert periodic.find_runs(np.array(ids, np.int64), np.array(ends)) == want


def test_large_periods():
    rnd = random.Random(9)
    for period in (64, 100, 127, 128, 511, 700):
        block = [rnd.randint(0, 20) for _ in range(period)]
        block[:40] = [1, 2] * 20  # highly periodic inside
        words = [-5, *block * 4, *block[:7], -6, *range(100, 300)]
        runs = periodic.find_runs(np.array([*words, -1], np.int64), np.array([len(words)]))
        assert runs[1, 1 + 4 * period + 7] == period
        assert runs == brute_runs(words)


@pytest.mark.parametrize("name", ["sf0.001"])
def test_query_over_the_whole_table(spark, name):
    got = {tuple(r) for r in queries.op11_periodic_runs(spark, f"/root/testdata/{name}").collect()}
    docs = table(name, "documents")
    assert got == {brute_row(d, t) for d, t in docs}
    assert sum(1 for d, _ in docs if zlib.crc32(str(d).encode()) % 10 == 0) > 5


def test_odd_tables(spark):
    long = " ".join(f"w{i % 5000}" for i in range(30_000)) + " x y" * 2000
    rows = [(1, None, "r"), (2, "", "r"), (3, " \t\n", "r"), (None, "a " * 6, "r"), (None, "a " * 6, "r"), (4, "a b " * 4, None), (5, "é\x0bé é\fé é é", "r"), (6, long, "r")]
    docs = spark.createDataFrame(rows, "doc_id smallint, text string, runs string").withColumnRenamed("runs", "cycle")
    found = periodic.periodic_runs(docs).collect()
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed if len(r.collapsed) < 50 else len(r.collapsed.split())) for r in found)
    assert got == [
        (0, 6, [(0, 6, 1)], "a"), (0, 6, [(0, 6, 1)], "a"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""),
        (4, 8, [(0, 8, 2)], "a b"), (5, 6, [(0, 6, 1)], "é"), (6, 34_000, [(0, 30_000, 5000), (30_000, 4000, 2)], 5002)]
    empty = periodic.digest(periodic.periodic_runs(docs.limit(0)))
    assert empty.count() == 0 and empty.columns[:3] == ["doc_id", "n_runs", "start"]
