import hashlib
import random
from collections import Counter

import pytest

from postings.llm import repeats as R


def brute(texts):
    data = [(t or "").encode() for t in texts]
    n = R.LENGTH
    seen = Counter(d[i:i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - n + 1):
            if seen[d[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rnd = random.Random(4)
    say = lambda n: "".join(rnd.choice("abcdefé ") for _ in range(n))
    passages = [say(n) for n in (150, 199, 200, 205, 260, 400, 900)]
    texts = [None, "", "short", "x" * 1000, "ab" * 400, say(199), say(200)]
    for i in range(60):
        parts = [say(rnd.randint(0, 300))]
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(passages)
            a = rnd.randrange(max(1, len(p) - 210))
            parts += [p[a:a + rnd.randint(180, 500)], say(rnd.randint(0, 60))]
        texts.append("".join(parts))
    texts += [texts[10], texts[11], texts[11][:-1] + "Z", texts[12] + "tail"]
    return texts


@pytest.mark.parametrize("limit", [1, 3, 2000])
def test_removal_matches_all_windows(spark, limit):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, kept int").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.remove_repeats(docs, group_limit=limit).collect()}
    want = brute(texts)
    assert {i for i in range(len(texts)) if got[i] != want[i]} == set()


def test_repeated_rows_null_ids_and_no_rows(spark):
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcdefgh") for _ in range(300))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text[:250]), (None, None)], "doc_id bigint, text string")
    assert sorted((r.n_bytes, r.n_removed) for r in R.remove_repeats(docs).collect()) == [(0, 0), (250, 250), (300, 300), (300, 300)]
    assert R.remove_repeats(docs.limit(0)).count() == 0


def test_merge_keeps_order_and_common_prefixes():
    rnd = random.Random(2)
    words = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 30))) for _ in range(500)]
    runs = [R.encode_run([(w, b"", i, 0, 0) for i, w in enumerate(words[k::7])]) for k in range(7)]
    merged = list(R.merge_runs([R.decode_run(r) for r in runs]))
    assert [m[1] for m in merged] == sorted(words)
    assert all(m[0] == R.common(a[1], m[1], 0) for a, m in zip(merged, merged[1:]))


def test_long_texts_are_cut_without_loss(monkeypatch):
    rnd = random.Random(1)
    text = bytes(rnd.choice(b"abcd") for _ in range(5000))
    whole = [(o + int(a) - int(s[0]), int(c)) for r, (o,), s, z, d in R.blocks(iter([(0, text)])) for a, c in zip(*[R.anchors(d, s, z)[i] for i in (0, 3)])]
    parts = set()
    for rows, offsets, starts, sizes, data in R.blocks(iter([(0, text)]), most=700):
        at, _, _, context = R.anchors(data, starts, sizes)
        for a, c in zip(at, context):
            k = max(i for i in range(len(starts)) if starts[i] <= a)
            parts.add((int(offsets[k] + a - starts[k]), int(c)))
    assert parts == set(whole)


def test_a_group_over_the_limit_hands_on_each_window_once():
    """Many variants of one passage: what leaves a part of the group is one row per different window."""
    rnd = random.Random(3)
    passage = bytes(rnd.choice(b"abcdefgh") for _ in range(240))
    entries = sorted((passage + bytes([65 + k % 26, 65 + k // 26]) * 2, (b"", k, k, 0)) for k in range(60))
    rows = list(R.repeated(iter([(0 if i == 0 else 240, s, p) for i, (s, p) in enumerate(entries)]), 88, 7))
    far = [r for r in rows if r[6] is not None]
    shared = len(passage) - R.LENGTH + 1
    assert len({(r[4], r[5]) for r in far}) <= shared + 60 * 4 and len(far) < 10 * shared + 60 * 5
    settled = {(r[0], w) for r in rows if r[6] is None for w in range(r[2], r[3] + 1)}
    assert {(k, w) for k in range(60) for w in range(shared)} - settled <= {(r[0], r[2]) for r in far if r[0] is not None}
