import hashlib
import random

import pyarrow.parquet as pq
import pytest

from postings.llm import pieces, queries

public_tokenizers = pytest.importorskip("public_tokenizers")


def table(name, what):
    rows = pq.read_table(f"/root/testdata/{name}/{what}.parquet", columns=["doc_id", "text"])
    return list(zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist()))


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def merger(model):
    return pieces.Merger(model)


def texts():
    rnd = random.Random(1)
    letters = list(" \n\t\r▁ab  eThtion.,é😀日本<s>0x41\x00​́ﬁ½")
    made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    return [*made, "", " " * 300, "a" * 5000, "\n" * 100, "日本語のテキスト", "print(x)\n    return  y\t\tz", "<0x0A></s>", "▁▁", "x" * 60 + " " + "tion" * 30]


def encoded(merger, some):
    ids, bounds = merger.encode(some)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_encode_is_the_librarys(merger):
    assert encoded(merger, texts()) == merger.library.encode(texts())
    assert encoded(merger, []) == [] and encoded(merger, ["", ""]) == [[], []]


def test_both_agendas_agree(merger):
    rnd = random.Random(2)
    letters = [c for c in "▁abeThtionTHE.,09é" if c in merger._rank]
    for length in range(2, pieces.SHORT + 1):
        some = ["".join(rnd.choice(letters) for _ in range(length)) for _ in range(100)]
        assert merger._merge_many(some) == [merger.merge(s) for s in some]


def test_a_difference_ends_the_job(model):
    wrong = pieces.Merger(model)
    del wrong._rank["▁with"]
    wrong._tables()
    with pytest.raises(ValueError, match="the library encodes '▁with'"):
        wrong.encode(["him with her"])


def test_many_sections_are_forgotten(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 10)
    small = pieces.Merger(model)
    for t in texts()[:300]:
        assert encoded(small, [t]) == small.library.encode([t])


def test_query_over_the_whole_table(spark, merger):
    got = {tuple(r) for r in queries.op12_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for doc_id, text in table("sf0.001", "documents"):
        ids = merger.library.encode(text or "")
        want.add((doc_id, len(ids), sha(",".join(map(str, ids))), sha(merger.library.decode(ids))))
    assert got == want


def test_odd_tables(spark, model):
    rows = [(1, None, 1), (2, "", 2), (None, "a b", 3), (None, "a b", 3), (3, " x \n", 4), (4, "word " * 400_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, ids int")
    got = sorted((r.doc_id or 0, len(r.ids), r.decoded if len(r.decoded) < 9 else len(r.decoded)) for r in pieces.encode_pieces(docs, model).collect())
    assert got[:4] == [(0, 2, "a b"), (0, 2, "a b"), (1, 0, ""), (2, 0, "")]
    assert got[4][2] == " x \n" and got[5][2] == 2_000_000
    assert pieces.digest(pieces.encode_pieces(docs.limit(0), model)).count() == 0
