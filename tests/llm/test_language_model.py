import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from postings.llm import language_model as M


def low(text):
    return [w for w in (text or "").encode().lower().split()]


def test_base_score_and_counts(spark):
    rnd = random.Random(1)
    texts = [None, "", "A a\tB", "é É"] + [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 2) for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    rows = [(i, t, 3.0) for i, t in enumerate(texts)] + [(None, "a b", 1.0), (7, texts[7], 2.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double").repartition(4)
    learn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    got = M.score_texts(docs, learn).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(t for i, x, _ in rows if not held(i) for t in [*low(x), "END"])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, x, _ in rows:
        tokens = [*low(x), "END"]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        want[i, held(i), len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)] += 1
    assert want == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert all(r.score < 0 for r in got)


def test_probabilities_sum_to_one(spark):
    rnd = random.Random(2)
    train = [" ".join(rnd.choice("aab") if k % 2 else "c" for k in range(rnd.randint(0, 2))) for _ in range(80)]
    every = [" ".join(t) for n in range(7) for t in itertools.product(["a", "b", "c", "zz"], repeat=n)]
    rows = [(i, t) for i, t in enumerate(train + every)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    scores = {r.doc_id: r.score for r in M.score_texts(docs, F.col("doc_id") < len(train)).collect()}
    total = sum(10 ** scores[i] for i in range(len(train), len(rows)))
    assert 0.98 < total <= 1 + 1e-9


def test_context_helps_on_held_out_texts(spark):
    rnd = random.Random(3)
    follows = {w: rnd.sample(range(40), 3) for w in range(40)}

    def say():
        w, out = rnd.randrange(40), []
        for _ in range(40):
            out.append(f"w{w}")
            w = rnd.choice(follows[w])
        return " ".join(out)

    docs = spark.createDataFrame([(i, say()) for i in range(200)], "doc_id bigint, text string")
    rows = M.score_texts(docs, F.col("doc_id") < 150).filter("held_out").collect()
    assert len(rows) == 50 and all(r.score > 0.6 * r.base_score for r in rows)


def test_seating_stays_within_bounds():
    rnd = np.random.default_rng(1)
    counts = rnd.integers(1, 5000, 300)
    tables = M.seat(counts, np.full(300, 50), np.full(300, 0.01), 0.7, 1.0, rnd)
    assert (tables >= 1).all() and (tables <= counts).all() and (tables[counts == 1] == 1).all()
    assert M.seat(np.array([4000]), np.array([10_000]), np.array([0.5]), 0.7, 1.0, rnd)[0] > 500
    assert M._unpack48(M._pack48(np.array([2**64 - 2**16, 2**16], np.uint64))).tolist() == [2**64 - 2**16, 2**16]


def test_sweeps_see_all_tables_however_dishes_are_dealt(spark, monkeypatch):
    """Seated without chance, scores follow from the tables alone: those of all parts, or they would change with the parts."""
    def seat(counts, elsewhere, served, discount, strength, rnd):
        odds = (strength + discount * elsewhere) * served
        return 1 + ((counts - 1) * odds / (1 + odds)).astype("int64")

    monkeypatch.setattr(M, "seat", seat)
    rnd = random.Random(6)
    say = lambda: " ".join(f"w{int(rnd.paretovariate(0.5)) % 60}" for _ in range(30))
    texts = [None, "", "  ", *[say() for _ in range(150)]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:9])], "doc_id bigint, text string")
    one, many = ({r.doc_id: r.score for r in M.score_texts(docs, F.col("doc_id") < 120, shares=n).collect()} for n in (1, 9))
    assert len(one) == docs.count() and all(math.isclose(one[i], many[i], rel_tol=1e-12) for i in one)


def test_a_sweep_seats_given_the_tables_of_others():
    seen = []

    def seat(counts, elsewhere, served, discount, strength, rnd):
        seen.append((counts.tolist(), elsewhere.tolist(), np.round(served, 6).tolist()))
        return np.minimum(counts, 2)

    before, M.seat = M.seat, seat
    try:
        tables, guests, parent = M.sweep(
            np.array([0, 1]), np.array([1, 0]), np.array([5, 2]), np.array([3, 0, 0]), np.array([4, 1]), np.array([2, 1, 0]), np.array([9, 70]), 10.0, 100.0, 20.0, None)
    finally:
        M.seat = before
    # Tables elsewhere: 70 - 4 and 9 - 1 in the contexts, 20 - 2 and 20 - 1 in the parent; a word without training stays without tables.
    served = [round((g - 0.7 * t + (10 + 0.7 * 20) / 11) / 110, 6) for g, t in ((7, 2), (1, 1))]
    assert seen == [([5, 2], [66, 8], served), ([5, 2], [18, 19], [round(1 / 11, 6)] * 2)]
    assert (tables.tolist(), guests.tolist(), parent.tolist()) == ([2, 2], [5, 2, 0], [2, 2, 0])


def test_steps_and_numbers_come_back():
    for a in ([], [0], [7, 3, 2**40, 5], list(range(300))):
        assert M._unpack_steps(M._pack_steps(np.array(a, np.int64))).tolist() == a == M._unpack(M._pack(np.array(a, np.int64))).tolist()


def test_no_rows_and_no_training(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert M.score_texts(docs.limit(0), F.lit(True)).count() == 0
    row = M.score_texts(docs, F.lit(False)).first()
    assert (row.n_known, row.train_tokens, row.base_score) == (0, 0, 0.0)


def test_scores_do_not_depend_on_the_session(spark):
    rnd = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(f"w{int(rnd.paretovariate(0.6)) % 300}" for _ in range(60))) for i in range(150)], "doc_id bigint, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for partitions, spread in (("2", 1), ("7", 5)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found.append({r.doc_id: r.score for r in M.score_texts(docs.repartition(spread), F.col("doc_id") < 120).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found[0]) == 150 and all(math.isclose(found[0][i], found[1][i], rel_tol=1e-12) for i in found[0])
    for kind in ("smallint", "decimal(9,0)", "string"):
        typed = M.score_texts(docs.selectExpr(f"CAST(doc_id AS {kind}) AS doc_id", "text"), F.col("doc_id") < 120)
        assert dict(typed.dtypes)["doc_id"] == kind and {int(r.doc_id) for r in typed.collect()} == set(found[0])
