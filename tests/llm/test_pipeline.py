"""Stages against their definitions, on a small table with all kinds of rows."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from checks.compare import connect, differences
from reviewmill.llm.queries import LLM_ORACLES, LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    pick = random.Random(1)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 9)))
    texts = [" ".join(word() for _ in range(pick.randint(60, 200))) for _ in range(60)]
    near = texts[0].split()
    near[5] = "changed"
    texts += [texts[1], texts[1].replace(" ", "\n"), " ".join(near), "short", None, "", " ".join(f"{w}###" for w in texts[2].split())]
    rows = [(i, t, "en", ["a", "b", None][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    return str(folder), texts


def test_stages(spark, documents, tmp_path):
    folder, texts = documents
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = [{r.doc_id for r in frame.select("doc_id").collect()} for frame in kept]
    n = len(texts)
    assert ids[0] == set(range(n)) - {n - 4, n - 3, n - 2, n - 1}  # short, null, empty, marked
    assert ids[0] - ids[1] == {60, 61}
    assert ids[1] - ids[2] == {62}
    assert ids[3] <= ids[2] and ids[4] == ids[3]
    assert kept[4].count() == kept[3].count()


def test_run_is_its_stages(spark, documents):
    folder, _ = documents
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_stages_take_an_empty_table(spark, documents):
    folder, _ = documents
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_registered(spark):
    names = {n.split("_")[0] for n in queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in queries()
    assert set(LLM_ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_queries_match_their_sql(spark, name):
    assert differences(LLM_QUERIES[name](spark, SF_DIR), connect(SF_DIR), LLM_ORACLES[name]) == []
