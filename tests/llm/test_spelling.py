import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from postings.llm import queries, spelling
from tests.llm.test_pieces import table


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def brute_vocabulary(docs, slip=97):
    tally = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % slip == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            tally[w] += 1
    return {w: n for w, n in tally.items() if len(w) >= 5 and n >= 3}


def brute_rows(tally):
    """Rows by comparing every word with all of its length and of one code point more."""
    by_length = defaultdict(list)
    for w in tally:
        by_length[len(w)].append(w)
    near = {w: set() for w in tally}
    for x in tally:
        for y in by_length[len(x)] + by_length[len(x) + 1]:
            if one_edit(x, y):
                near[x].add(y)
                near[y].add(x)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-tally[o], o), default=None)
        form[w] = best if best and tally[best] >= 2 * tally[w] else None
    rows = set()
    for w in tally:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, tally[w], len(near[w]), tally[form[w]] if form[w] else None))
    return rows


def words(spark, tally):
    return spark.createDataFrame(list(tally.items()), "word string, n bigint").repartition(3)


@pytest.mark.parametrize("bucket", [2, 20, 1024])
def test_all_pairs_at_any_size_of_bucket(spark, bucket):
    rnd = random.Random(4)
    tally = {}
    for _ in range(12):
        base = [rnd.choice("abé") for _ in range(rnd.randint(5, 14))]
        for _ in range(30):
            w = list(base)
            for _ in range(rnd.randint(0, 2)):
                kind, at = rnd.randrange(3), rnd.randrange(len(w))
                w[at:at + (kind > 0)] = [] if kind == 2 else [rnd.choice("abcé")]
            tally["".join(w)] = rnd.randint(3, 40)
    tally |= {"a" * k: 3 * k for k in range(5, 12)} | {"abcde" + c: 9 for c in "abcdefghijklmnop"}
    got = [tuple(r) for r in spelling.near_words(words(spark, tally), bucket).collect()]
    want = {(x, y, tally[y]) for x in tally for y in tally if one_edit(x, y)}
    assert len(got) == len(want) and set(got) == want  # each pair once each way
    assert {tuple(r) for r in spelling.group_spellings(words(spark, tally), bucket=bucket).collect()} == brute_rows(tally)


def test_query_over_the_whole_table(spark):
    got = [tuple(r) for r in queries.op13_spelling_variants(spark, "/root/testdata/sf0.001").collect()]
    want = brute_rows(brute_vocabulary(table("sf0.001", "documents")))
    assert len(got) == len(want) and set(got) == want
    assert any(r[1] for r in want) and any(r[1] and r[2] != r[1] for r in want)


def test_slips_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "STEP", 7)
    docs = [(i, "Color COLOUR colour×Ünïcode-über " + "color " * (i % 3)) for i in range(300)]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    for slip in (2, 97):
        assert {r.word: r.n for r in spelling.vocabulary(rows, slip=slip).collect()} == brute_vocabulary(docs, slip)


def test_chains_ties_and_odd_tables(spark):
    tally = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 100, "baaaa": 6, "zzzzz": 3}
    rows = {r.word: r for r in spelling.group_spellings(words(spark, tally)).collect()}
    assert (rows["aaaaa"].form, rows["aaaaa"].root, rows["aaaaa"].n_near) == ("aaaab", "aabbb", 2)  # tie of 6: smallest
    assert (rows["zzzzz"].form, rows["zzzzz"].root, rows["zzzzz"].n_near, rows["zzzzz"].form_n) == (None, "zzzzz", 0, None)
    odd = [(None, "abcde abcde", "x"), (1, None, "y"), (2, "", "z"), (3, "abcde abcd", None), (3, "abcde abcd", None)]
    docs = spark.createDataFrame(odd, "doc_id int, text string, n string").withColumnRenamed("n", "word")
    assert {tuple(r) for r in spelling.vocabulary(docs).collect()} == {("abcde", 4)}
    assert spelling.group_spellings(spelling.vocabulary(docs.limit(0))).collect() == []
