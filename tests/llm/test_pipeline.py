import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from postings.llm import decontaminate, mixing, quality, secrets, simhash
from tests.llm.test_simhash import brute_components, brute_print


def text(rnd, n):
    common = "the of and to in that is was for".split()
    return " ".join(rnd.choice(common) if rnd.random() < 0.3 else "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(11)
    items = [text(rnd, 30) for _ in range(4)]
    docs = [text(rnd, rnd.randint(5, 90)) for _ in range(60)]
    docs += docs[:5] + [docs[7] + " extra"] + [f"{docs[k]} {items[k % 4]} {docs[k + 1]}" for k in range(20, 26)]
    docs += [f"{docs[k]} password=abcdef123456 and AKIA{'A1' * 8} {text(rnd, 20)}" for k in range(30, 34)] + ["word " * 40, "", None, "# " * 60]
    rows = [(i, t, ["en", None][i % 2], [None, "a", "b", "c"][i % 4], len(t or "")) for i, t in enumerate(docs)]
    path = str(tmp_path_factory.mktemp("pipe"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_stages_against_brute_force(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "benchmark decontamination", "secret scans", "source mixing"]

    good = stages["quality rules"](spark, docs, path)
    assert good.columns == columns
    kept = {r.doc_id for r in quality.judge_quality(docs).filter("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and kept < {r[0] for r in rows}

    ours = [r for r in rows if r[0] in kept]
    roots = brute_components([brute_print(r[1]) for r in ours])
    single = {min(ours[k][0] for k in range(len(ours)) if roots[k] == root) for root in set(roots)}
    deduped = stages["SimHash near-dedup"](spark, good, path)
    assert deduped.columns == columns and sorted(r.doc_id for r in deduped.collect()) == sorted(single)

    clean = stages["benchmark decontamination"](spark, deduped, path)
    leaking = {r[0] for r in ours if any(i in r[1] for i in items)}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == single - leaking

    safe = stages["secret scans"](spark, clean, path)
    texts = {r.doc_id: r.text for r in safe.collect()}
    assert safe.columns == columns and set(texts) == single - leaking
    scan = secrets.scanner(secrets.RULES)
    for r in ours:
        if r[0] in texts:
            spans = sorted((a, b) for found in scan(r[1], set()).values() for _, a, b in found)
            want, at = "", 0
            for a, b in spans:
                if a >= at:
                    want += r[1][at:a] + "[secret]"
                at = max(at, b)
            assert texts[r[0]] == want + r[1][at:]

    mixed = stages["source mixing"](spark, safe, path)
    taken = {r.doc_id: r.copies for r in mixed.collect()}
    plan = {r.doc_id: r.taken for r in mixing.mix_sources(safe).collect()}
    size = {r.doc_id: r.n for r in safe.select("doc_id", F.size(F.split("text", " ")).alias("n")).collect()}
    assert all(plan[i] == taken.get(i, 0) * size[i] for i in plan)


def test_run_is_the_stages(spark, folder):
    path, rows, _ = folder
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copies"]
    assert 0 < out.count() < len(rows)


def test_decontamination_of_repeated_and_null_rows(spark):
    docs = spark.createDataFrame([(1, "x"), (1, "x"), (None, None), (2, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, None)], "item_id bigint, text string")
    assert decontaminate.drop_leaks(docs, bench).count() == 4


def test_columns_with_the_names_of_helpers_stay(spark):
    names = ["blob", "secret_spans", "spans", "row", "at", "out", "full", "last_hash", "copies", "mix_key", "mix_hash", "size", "rest", "simhash_key", "simhash_mark", "doc_id_"]
    docs = spark.createDataFrame(
        [(k, f"password=abc{k}def0 and word{k} " + " ".join(f"w{k}x{j}" for j in range(30)), "ab"[k % 2], *[f"{n}{k}" for n in names]) for k in range(8)],
        "doc_id bigint, text string, source string, " + ", ".join(f"{n} string" for n in names))
    for stage in (secrets.redact, mixing.apply_mix, simhash.keep_one):
        out = stage(docs)
        assert set(docs.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
        for r in out.collect():
            assert all(r[n] == f"{n}{r.doc_id}" for n in names if n != "copies" or stage is not mixing.apply_mix)
            assert (f"abc{r.doc_id}def0" in r.text) == (stage is not secrets.redact)
