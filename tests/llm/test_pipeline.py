import hashlib
import os
from collections import Counter

import corpus_pipeline
import __spark_entry__ as E
from tests.llm import brute
from tests.llm.conftest import frame
from vitrine.llm import queries

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = list(E.queries())
    assert all(len([x for x in names if x.startswith(f"op{n}_")]) == 1 for n in range(1, 11)) and "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)


def test_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    stage = dict(corpus_pipeline.STAGES)
    one = stage[names[0]](spark, docs, SF)
    assert {r.doc_id for r in one.collect()} == {i for i, r in rows.items() if any(c.isalpha() for c in r.text or "")}
    predicted = {r.doc_id: r.lang_pred for r in queries.op6_cross_parsing(spark, SF).collect()}
    assert all(r.lang == predicted[r.doc_id] for r in one.collect())  # the stage writes what it has found
    two = stage[names[1]](spark, one, SF)
    last = {}
    for r in one.collect():
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert {r.doc_id for r in two.collect()} == set(last.values())
    three = stage[names[2]](spark, two, SF)
    left = sorted(last.values())
    comp = brute.components([brute.shingles(rows[i].text) for i in left])
    assert {r.doc_id for r in three.collect()} == {left[c] for c in comp}
    for df in (one, two, three):
        assert df.columns == docs.columns


def test_run_ends_with_token_digests(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert out and max(Counter(r.doc_id for r in out).values()) <= 2
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in out)


def test_every_stage_takes_the_awkward_rows_and_no_rows(spark, docs, no_docs):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for start in (plain, no_docs.select(*plain.columns)):
        at = start
        for _, stage in corpus_pipeline.STAGES:
            assert at.columns == plain.columns
            at = spark.createDataFrame(stage(spark, at, SF).collect(), stage(spark, at, SF).schema)
        assert at.count() <= 2 * start.count()


def test_oracles(spark):
    from tools.check_oracle import digest, duck

    con = duck(SF)
    for name, sql in queries.ORACLE_SQL.items():
        df = queries.QUERIES[name](spark, SF)
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        assert sorted(cols) == sorted(df.columns), name
        assert digest(df.columns, [tuple(r) for r in df.collect()])[1] == digest(cols, res.fetchall())[1], name


def test_operators_do_not_swallow_import_errors():
    folder = os.path.dirname(queries.__file__)
    for f in [*(os.path.join(folder, x) for x in os.listdir(folder) if x.endswith(".py")), corpus_pipeline.__file__]:
        assert "ImportError" not in open(f, encoding="utf-8").read()


def test_frame_has_clashing_columns(spark):
    assert len(frame(spark, [(1, "a", "en", "s")]).columns) > 20
