import random

import pytest
import xxhash
from pyspark.sql import functions as F

from postings.llm import simhash


def brute_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    value = 0
    for bit in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(s.encode(), 42) >> bit & 1 for s in shingles) > len(shingles):
            value |= 1 << bit
    return value


def brute_components(prints):
    """{index: root index} by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def texts(seed=1):
    rnd = random.Random(seed)
    words = ["w%d" % i for i in range(300)] + ["Ünï", "ABC"]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 120))) for _ in range(40)]
    out = ["", None, "one", "One", "a b", " \t\n"]
    for t in base:
        out.append(t)
        for _ in range(3):
            w = t.split(" ")
            w[rnd.randrange(len(w))] = rnd.choice(words)
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("limit", [2, 32])
def test_groups_match_all_pairs(spark, limit):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id bigint, text string, fp string").repartition(3)
    got = {r.doc_id: r for r in simhash.simhash_groups(docs, run_limit=limit).collect()}
    prints = [brute_print(t) for t in rows]
    assert [int(got[i].fingerprint, 16) for i in range(len(rows))] == prints
    assert [got[i].component_id for i in range(len(rows))] == brute_components(prints)


def test_links_connect_what_all_pairs_connect(spark):
    rnd = random.Random(5)
    centres = [rnd.getrandbits(64) for _ in range(4)]
    prints = list({c ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(12)) ^ (rnd.getrandbits(3) << 61) for c in centres for _ in range(120)} | {0, 2**64 - 1, 2**63})
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    for limit in (2, 8, 500):
        links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp bigint").repartition(4), limit).collect()
        root = {p: p for p in signed}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for r in links:
            assert ((r.u ^ r.v) & (2**64 - 1)).bit_count() <= 2
            root[find(r.u)] = find(r.v)
        want = brute_components(prints)
        ours = [find(p) for p in signed]
        assert len(set(zip(want, ours))) == len(set(want)) == len(set(ours))


def test_keep_one(spark):
    docs = spark.createDataFrame(
        [(5, "a b c d", "n"), (3, "A b c d", "m"), (3, "A b c d", "m"), (None, "q r s t u", None), (None, "completely other words here", None), (9, None, "k"), (8, "", "k")],
        "doc_id bigint, text string, best string")
    kept = {(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()}
    assert kept == {(3, "A b c d"), (None, "q r s t u"), (None, "completely other words here"), (8, "")}
    assert simhash.keep_one(docs).columns == docs.columns


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.simhash_groups(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0
    assert simhash.simhash_groups(docs.unionAll(spark.createDataFrame([(None, None)], "doc_id bigint, text string"))).select(F.col("component_id")).first()[0] is None
