import duckdb
import pytest

import corpus_pipeline
from crewspark.llm import bpe, registry
from crewspark.llm.common import stage, table

from .test_decontaminate import brute
from .test_near_duplicates import brute_texts

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, [docs]
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, SF), f"test-{name}")
        kept.append(docs)
        assert name == "encode" or docs.columns == columns
    rows = [sorted((r["doc_id"], r["text"]) for r in d.collect()) for d in kept[:-1]]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    gone = {i for i, _ in rows[0]} - {i for i, _ in rows[1]}
    assert sum(labels.get(i) == 1 for i in gone) <= 1  # clean labelled documents stay
    assert len(rows[1]) - len(rows[2]) <= 1  # all are in known languages
    assert {i for i, _ in rows[3]} == {r[0] for r in brute_texts(rows[2], 5, 80, 100) if r[3]}
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    assert {i for i, _ in rows[4]} == {i for i, _ in rows[3]} - {d for d, _ in brute(rows[3], items)}
    coder = bpe.encoder(bpe.byte_bpe_path())
    assert {r["doc_id"]: r["n_tokens"] for r in kept[-1].collect()} == {i: len(coder.encode([t])[0]) for i, t in rows[4]}


@pytest.mark.parametrize("at", range(5))
def test_stages_take_nulls_and_empty_tables(spark, frame, at):
    schema = table(spark, SF, "documents").schema.add("kept", "string").add("shifts", "string")
    rows = [(None,) * 7, (1, None, "en", "s", 0, "x", "y"), (2, "the and of to", None, None, None, None, None), (2, "the and of to", None, None, None, None, None)]
    name, apply = corpus_pipeline.STAGES[at]
    got = apply(spark, frame(rows, schema), SF)
    assert got.count() <= 4
    if name != "encode":
        assert got.columns == schema.names
    assert apply(spark, frame([], schema), SF).count() == 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_equal_their_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    got = registry.queries()[name](spark, SF).select(*names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want.fetchall(), key=str)
