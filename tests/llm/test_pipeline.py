"""The pipeline against brute force from the toxicity decisions on, and every stage on odd tables."""

import hashlib

import pytest

import corpus_pipeline as P
from obsflow.llm.toxicity import toxicity_scores
from obsflow.session import work_dir
from tests.conftest import SF001
from tests.llm import test_decontaminate, test_line_dedup, test_minhash, test_mixing


def lines_kept(rows):
    kept = {}
    want = {(i, sha) for i, _, _, sha in test_line_dedup.brute([(r[0], r[1]) for r in rows])}
    holders = {}
    key = lambda line: test_line_dedup.fold(line.strip(test_line_dedup.BLANK))
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(i)
    for i, t, *_ in rows:
        kept[i] = "\n".join(x for x in (t or "").split("\n")
                            if not (len(holders.get(key(x), ())) >= 5 and max(holders[key(x)]) != i))
        assert (i, hashlib.sha256(kept[i].encode()).hexdigest()) in want
    return [(r[0], kept[r[0]], *r[2:]) for r in rows]


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    bad = {r.doc_id for r in toxicity_scores(docs, docs, spark.read.parquet(f"{SF001}/labels.parquet"))
           .where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id not in bad]
    rows = lines_kept(rows)
    keep = {r[0] for r in test_minhash.brute([r[:2] for r in rows]) if r[3]}
    rows = [r for r in rows if r[0] in keep]
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {r[0] for r in test_decontaminate.brute([r[:2] for r in rows], items) if r[4]}
    rows = [r for r in rows if r[0] not in hit]
    assert bad and hit and len(keep) < docs.count() - len(bad)
    got = sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken, r.first_slot)
                  for r in P.run(spark, SF001).collect()), key=repr)
    assert got == test_mixing.brute(rows)


ODD = [(1, "a b c", "en", "s", 5, "x", 1), (1, "a b c", "en", "s", 5, "x", 1), (2, None, None, None, None, None, None),
       (None, "a b c", "en", "s", 5, "x", 1), (None, None, None, None, None, None, None), (3, "", "en", "s", 0, "x", 1),
       (4, "long " * 100_000, "en", "t", 500_000, "x", 1), (5, "\n", "en", "s", 1, "x", 1)]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept_text string, score int")


@pytest.mark.parametrize("rows", [ODD, []])
def test_stages_on_odd_tables(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    folder = work_dir(spark, "odd")
    spark.createDataFrame([(1, None, 0), (4, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(None, None), (1, ""), (2, "nothing of the kind")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        got = sorted(map(tuple, out.collect()), key=repr)
        want = rows if name != "minhash_dedup" else sorted({repr(r): r for r in rows}.values(), key=repr)
        assert got == sorted(want, key=repr), name
    assert P.STAGES[-1][1](spark, docs, folder).count() == len(rows)


def test_line_stage_changes_text_and_count(spark):
    line = "the same line of more than forty characters, shared"
    docs = spark.createDataFrame([(i, f"{line}\nown {i}", "en", "s", 99) for i in range(5)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in P.dedup_lines(spark, docs, "").collect()}
    assert got[0] == ("own 0", 5) and got[4] == (f"{line}\nown 4", 99)
