"""The pipeline's stages on the small documents, each held against its own input; and the registered queries."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpusloom.llm import quality_gam, queries, toxicity
from corpusloom.llm.common import read_table
from test_llm_dedup import brute_fingerprint, brute_removed, groups_of

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark):
    from corpusloom.llm.common import saved

    docs, out = read_table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        got = saved(stage(spark, docs, SF), "test-stage")
        out.append((name, docs, got))
        docs = got
    return out


def test_stage_columns(spark, stages):
    want = read_table(spark, SF, "documents").dtypes
    for _, _, got in stages[:-1]:
        assert got.dtypes == want


@pytest.mark.parametrize("at,module,label,keep", [(0, toxicity, "toxic", lambda s: s < 0.5), (1, quality_gam, "quality", lambda s: s >= 0.3)])
def test_classifier_stages_drop_what_they_reject(spark, stages, at, module, label, keep):
    _, docs, got = stages[at]
    fit = module.fit_toxicity if label == "toxic" else module.fit_quality
    score = module.score_toxicity if label == "toxic" else module.score_quality
    model = fit(module.labelled_sample(docs, read_table(spark, SF, "labels"), label, module.SAMPLE))
    kept = {r.doc_id for r in score(docs, model).collect() if keep(r.score)}
    before, after = rows_of(docs), rows_of(got)
    assert set(after) == kept and all(after[i] == before[i] for i in kept)


@pytest.mark.parametrize("case", ["no labels", "held out only", "toxic only", "no telling n-gram"])
def test_toxicity_stage_that_learned_nothing_drops_nothing(spark, tmpdir_path, case):
    words = ["river", "stone", "meadow", "cloud"]
    docs = spark.createDataFrame([(i, f"{words[i % 4]} and {words[i // 4 % 4]}", "en", "s", 9) for i in range(60)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    held = {i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0}
    y = {"no labels": {}, "held out only": {i: i % 2 for i in held}, "toxic only": dict.fromkeys(range(60), 1),
         "no telling n-gram": {i: int(i // 16 % 4 != 0) for i in range(60)}}[case]
    spark.createDataFrame(list(y.items()), "doc_id long, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    got = corpus_pipeline.drop_toxic(spark, docs, tmpdir_path)
    assert got.dtypes == docs.dtypes and sorted(got.collect()) == sorted(docs.collect())
    rows = toxicity.toxicity(docs, read_table(spark, tmpdir_path, "labels")).collect()
    assert len(rows) == 60 and {r.predicted for r in rows} == {0} and max(r.score for r in rows) < 0.5


@pytest.mark.parametrize("case", ["no labels", "bad only", "good only", "labels of other documents"])
def test_quality_stage_that_learned_nothing_drops_nothing(spark, tmpdir_path, case):
    docs = spark.createDataFrame([(i, f"a river {i}", "en", "s", 9) for i in range(60)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    y = {"no labels": {}, "bad only": dict.fromkeys(range(60), 0), "good only": dict.fromkeys(range(60), 1),
         "labels of other documents": {i: i % 2 for i in range(1000, 1100)}}[case]
    spark.createDataFrame(list(y.items()), "doc_id long, quality int").write.parquet(f"{tmpdir_path}/labels.parquet")
    got = corpus_pipeline.keep_quality(spark, docs, tmpdir_path)
    assert got.dtypes == docs.dtypes and sorted(got.collect()) == sorted(docs.collect())
    rows = quality_gam.quality(docs, read_table(spark, tmpdir_path, "labels")).collect()
    assert len(rows) == 60 and {r.predicted for r in rows} == {1}


@pytest.mark.parametrize("label", ["toxic", "quality"])
def test_the_labelled_sample_is_bounded_in_rows(spark, label):
    docs = spark.range(20_000).selectExpr("7L AS doc_id", "CAST(id % 3 AS STRING) AS text")
    docs = docs.unionByName(spark.range(100, 160).selectExpr("id AS doc_id", "IF(id % 2 = 0, NULL, 'x') AS text"))
    labels = spark.range(5_000).selectExpr("id AS doc_id", f"CAST(id % 2 AS INT) AS {label}")
    have = [i for i in [7, *range(100, 160)] if zlib.crc32(str(i).encode()) % 5]
    assert toxicity.labelled_sample(docs, labels, label, 1000).count() == len(have)
    assert toxicity.labelled_sample(docs, labels, label, 20).count() == 20
    one = toxicity.labelled_sample(docs.where("doc_id = 7"), labels, label, 50).collect()
    assert len(one) == 1 and one[0].text in ("0", "1", "2") and one[0].y == 1


def test_simhash_stage(stages):
    _, docs, got = stages[2]
    rows = sorted(rows_of(docs).items())
    fps = [brute_fingerprint(r.text) for _, r in rows]
    label = groups_of(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    assert sorted(rows_of(got)) == [rows[i][0] for i, c in enumerate(label) if c == i]


def test_simhash_stage_keeps_one_row_a_group_of_repeated_and_null_ids(spark):
    a, b, c, d = ("alpha beta gamma delta epsilon", "one two three four five six", "red green blue white black", "up down left right in out")
    rows = [(7, a), (7, a), (None, a), (9, a), (None, b), (None, b), (4, c), (4, d), (3, d), (3, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 5) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.one_per_group(spark, docs.repartition(3), SF)
    assert got.dtypes == docs.dtypes
    assert sorted((r.doc_id or -1, r.text or "") for r in got.collect()) == sorted([(7, a), (-1, b), (4, c), (3, d), (3, "")])


def test_suffix_stage(stages):
    _, docs, got = stages[3]
    rows, after = sorted(rows_of(docs).items()), rows_of(got)
    removed = brute_removed([(k, i, r.text) for k, (i, r) in enumerate(rows)], 100)
    for doc, data, gone in removed.values():
        text = bytes(np.frombuffer(data, np.uint8)[~gone]).decode("utf-8", "ignore")
        assert after[doc].text == text and after[doc].n_chars == len(text)
    assert len(after) == len(rows)


def test_packing_stage_and_run(spark, stages):
    _, docs, got = stages[4]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    ids = {i: np.array(t.encode(r.text, add_special_tokens=False).ids + [1], "<u4") for i, r in rows_of(docs).items()}
    pieces = got.collect()
    assert all(p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) for p in pieces)
    assert sum(p.length for p in pieces) == sum(map(len, ids.values()))
    assert {(p.doc_id, p.doc_tokens) for p in corpus_pipeline.run(spark, SF).collect()} == {(i, len(x)) for i, x in ids.items()}


def test_every_dealt_operator_is_registered():
    import __spark_entry__

    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    want = want.fetchall()
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want)


