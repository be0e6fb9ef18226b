import random

import numpy as np

from postings.llm import decontaminate as D


def edit_distance(item, text):
    """Least edits between the item and any substring, by the full table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


def normal(text):
    return " ".join("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split())


def test_distances_of_many():
    rnd = random.Random(1)
    items = ["".join(rnd.choice("abé ") for _ in range(rnd.choice([1, 5, 63, 64, 65, 100, 130, 200]))) for _ in range(40)]
    texts = ["".join(rnd.choice("abé x") for _ in range(rnd.randint(0, 250))) for _ in items]
    texts = [t[:20] + i[:len(i) // 2] + i[len(i) // 2 + 2:] + t[20:] if k % 2 else t for k, (i, t) in enumerate(zip(items, texts))]
    held = D.Items.of(list(range(40)), [b""] * 40, walks=0)
    patterns = D.Patterns(items)
    for most in (0, 3, 400):
        limits = np.full(40, most)
        full = D.Items(held.ids, items, held.n_words, limits, [], [], [], [], held.trigrams, held.wide, patterns)
        best, end = full.within(np.arange(40), [patterns.codes(t) for t in texts], chunk=7)
        for item, text, d, e in zip(items, texts, best.tolist(), end.tolist()):
            want = edit_distance(item, text)
            assert d == want if want <= most else d > most
            if want <= most:
                assert edit_distance(item, text[:e]) == want and (e == 0 or want == len(item) or edit_distance(item, text[:e - 1]) > want)


def test_word_table():
    texts = [b"One  two\tTHREE", b"", b" one\n", "é x".encode()]
    data, starts, ends, hashes, counts = D.word_table(texts)
    assert counts.tolist() == [3, 0, 1, 2]
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == [b"one", b"two", b"three", b"one", "é".encode(), b"x"]
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 5


def test_recall_against_all_texts(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghijklmnoprstu") for _ in range(rnd.randint(2, 9))) for _ in range(600)]
    say = lambda n: [rnd.choice(words) for _ in range(n)]
    items = [say(rnd.randint(15, 45)) for _ in range(8)] + [say(4), []]
    docs = []
    for i in range(90):
        text = say(rnd.randint(0, 90))
        if i % 2:
            part = list(items[rnd.randrange(9)])
            for _ in range(rnd.randrange(1 + len(part) // 7)):
                part[rnd.randrange(len(part))] = rnd.choice(words)
            at = rnd.randrange(len(text) + 1)
            text[at:at] = part
        docs.append((i, " ".join(text).title() if i % 5 == 0 else " \n".join(text)))
    docs += [(900, None), (901, ""), (None, " ".join(items[0])), (902, " ".join(items[1])), (902, " ".join(items[1]))]
    bench = [(i, " ".join(t)) for i, t in enumerate(items)] + [(99, None)]
    frames = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), spark.createDataFrame(bench, "item_id bigint, text string")
    got = D.find_leaks(*frames).collect()
    assert sum(r.doc_id is None for r in got) == 1 and sum(r.doc_id == 902 for r in got) == 2
    found = {}
    for r in got:
        found[r.doc_id, r.item_id] = min(r.distance, found.get((r.doc_id, r.item_id), r.distance))
    want = {}
    for i, text in docs:
        for k, item in bench:
            target = normal(item or "")
            d = edit_distance(target, normal(text or ""))
            if target and text and d <= 0.2 * len(target):
                want[i, k] = d
    assert set(found) <= set(want)
    assert all(found[k] >= want[k] for k in found) and sum(found[k] == want[k] for k in found) >= 0.98 * len(found)
    assert len(found) >= 0.95 * len(want)
    blocks = D.find_leaks(*frames, max_item_bytes=300).collect()
    apart = {(r.doc_id, r.item_id) for r in blocks}
    assert apart <= set(want) and len(apart) >= 0.95 * len(want)  # words are counted within a block
    kept = D.drop_leaks(*frames)
    assert kept.count() == len([d for d in docs if d[0] not in {k[0] for k in found}])
    assert D.find_leaks(frames[0].limit(0), frames[1]).count() == D.find_leaks(frames[0], frames[1].limit(0)).count() == 0


def test_keys_survive_shifted_windows():
    h = D.mix(np.arange(40, dtype=np.uint64), 3)
    for r in range(D.repetitions()):
        assert (D.walk_keys(h, r)[0][5:20] == D.walk_keys(h[5:], r)[0][:15]).all()


def edited(rnd, words, how):
    typo = lambda w: rnd.choice([w[1:] + "z", "q" + w, w[:-1], w[:1] + "y" + w[2:]]) or "q"
    if how == "first":
        return [typo(words[0]), *words[1:]]
    if how == "half":
        some = set(rnd.sample(range(len(words)), len(words) // 2))
        return [typo(w) if k in some else w for k, w in enumerate(words)]
    every = {"second": 2, "third": 3}[how]
    return [typo(w) if k % every == every - 1 else w for k, w in enumerate(words)]


def test_recall_by_length_and_edits():
    """Items of a language with common and rare words; those whose edits exceed the similarity are left out."""
    rnd = random.Random(6)
    rare = ["".join(rnd.choice("abcdefghijklmnoprstu") for _ in range(rnd.randint(4, 10))) for _ in range(5000)]
    common = "the of and to in that is was for it on as with".split()
    say = lambda n: [rnd.choice(common) if rnd.random() < 0.35 else rnd.choice(rare) for _ in range(n)]
    for low, high, least in ((3, 7, 1.0), (8, 9, 0.85), (10, 14, 0.9), (15, 30, 0.95), (31, 60, 0.98)):
        items = [say(rnd.randint(low, high)) for _ in range(120)]
        held = D.Items.of(list(range(len(items))), [" ".join(w).encode() for w in items])
        for how in ("first", "third", "second", "half"):
            texts = [" ".join([*say(30), *edited(rnd, w, how), *say(30)]).encode() for w in items]
            found = {(r[0], r[1]) for r in D._scan(held, texts)}
            true = [k for k, w in enumerate(items) if edit_distance(" ".join(w), texts[k].decode()) <= held.most[k]]
            assert true and sum((k, k) in found for k in true) >= least * len(true), (low, how, len(true))


def test_types_nulls_and_clashing_columns(spark):
    said = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame(
        [(1, said, "a", 1), (2, "nothing of it", "b", None), (None, None, None, 2), (3, "", "c", 3), (4, f"x {said} " * 3, "d", 4), (4, "ok", "d", 4)],
        "doc_id smallint, text string, leak_row string, item_id int")
    for kind in ("int", "decimal(5,0)", "string", "smallint"):
        bench = spark.createDataFrame([(7, said), (None, said.upper()), (8, None), (9, " ")], "item_id int, text string").selectExpr(f"CAST(item_id AS {kind}) AS item_id", "text")
        got = D.find_leaks(docs, bench)
        assert dict(got.dtypes)["doc_id"] == "smallint" and dict(got.dtypes)["item_id"] == kind
        rows = {(r.doc_id, r.item_id and int(r.item_id)) for r in got.collect()}
        assert rows == {(1, 7), (1, None), (4, 7), (4, None)}
    kept = D.drop_leaks(docs, bench)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (2, "nothing of it"), (3, ""), (4, "ok")]
    assert D.drop_leaks(docs, bench.limit(0)).count() == 6 and D.drop_leaks(docs.limit(0), bench).count() == 0


def test_very_long_texts():
    rnd = random.Random(8)
    item = " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(30))
    text = ("filler words again and again " * 80_000 + item + " tail" * 1000).encode()
    assert [(r[1], r[4]) for r in D._scan(D.Items.of([0], [item.encode()]), [b"", text])] == [(0, 0)]
