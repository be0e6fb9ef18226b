import random

import numpy as np
import pytest

from postings.llm import toxicity as T


def brute_kernel(s, t):
    """Sum over common three-letter subsequences of DECAY to the spans."""
    a, b = T.letter_codes(s), T.letter_codes(t)
    total = 0.0
    for i in range(len(a)):
        for j in range(i + 1, len(a)):
            for k in range(j + 1, len(a)):
                for x in range(len(b)):
                    for y in range(x + 1, len(b)):
                        for z in range(y + 1, len(b)):
                            if a[i] == b[x] > 0 and a[j] == b[y] > 0 and a[k] == b[z] > 0:
                                total += T.DECAY ** (k - i + 1 + z - x + 1)
    return total


def test_kernel_matches_the_sum_over_subsequences():
    words = ["loser", "l.o.s.e.r", "banana", "élève", "abc", "l0ser"]
    got = T.kernel_rows(words, words)
    norm = [brute_kernel(w, w) ** 0.5 for w in words]
    want = [[brute_kernel(s, t) / norm[i] / norm[j] for j, t in enumerate(words)] for i, s in enumerate(words)]
    assert np.allclose(got, want, atol=1e-5)


def test_words():
    assert set(T.words_of("You l o s e r, LOSER! ok a")) == {"you", "loser", "loser,"[:5]}
    assert T.words_of("") == [] and T.pieces("a" * 45)[0] == "a" * 20
    assert "".join(T.pieces("abcdefghij" * 5)).count("abc") >= 5


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(3)
    syllables = ["tha", "rin", "ou", "bel", "ston", "er", "an", "mi", "cor"]
    clean = lambda: ["".join(rnd.choice(syllables) for _ in range(rnd.randint(2, 4))) for _ in range(60)]
    insults = ["idiot", "loser", "pathetic", "worthless"]
    rows = []
    for i in range(600):
        words, toxic = clean(), int(i % 3 == 0)
        for _ in range(4 * toxic):
            words.insert(rnd.randrange(len(words)), rnd.choice(insults))
        rows.append((i, " ".join(words), toxic, "x"))
    rows += [(1000, None, 0, "x"), (1001, "", 0, "x"), (None, "idiot", 1, "x"), (5, rows[5][1], rows[5][2], "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxic int, score string")


def test_held_out_and_gapped_insults(spark, labelled):
    model = T.train(labelled.filter("doc_id < 400"), labelled.filter("doc_id < 400"))
    rows = T.score(labelled, model).join(labelled.drop("score"), "doc_id").filter("doc_id BETWEEN 400 AND 599").collect()
    assert sum((r["score"] >= 0.7) == (r["toxic"] == 1) for r in rows) >= 0.9 * len(rows)
    plain = "tharin oubel stoner anmicor rincor"
    assert model.margins(["l.o.s.e.r", "idi-ot", "path_etic", "worthl*ess"]).min() > model.margins(plain.split()).max()
    scores = model.scores([plain, f"{plain} idiot loser", f"{plain} l o s e r pathetic", "", None])
    assert scores[0] < 0.5 < scores[1:3].min() and scores[3] == scores[4] < 0.5


def test_odd_tables(spark, labelled):
    empty = labelled.limit(0)
    assert T.score(empty, T.train(empty, empty)).count() == 0
    one_label = labelled.filter("toxic = 0")
    assert {round(r.score, 6) for r in T.score(labelled, T.train(one_label, one_label)).collect()}.__len__() == 1
    assert T.score(labelled, T.train(labelled, labelled)).count() == labelled.count()
