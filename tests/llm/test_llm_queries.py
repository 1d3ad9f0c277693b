"""The queries of the training-data operators against their SQL twins and against plain recomputation."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from compare import duckdb_on, duckdb_result, spark_result

import corpus_pipeline
from dayfold.llm import token_counts
from dayfold.llm.oracles import ORACLES
from dayfold.llm.queries import QUERIES, tokenizer_file


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, name):
    assert spark_result(QUERIES[name](spark, sf_dir)) == duckdb_result(duckdb_on(sf_dir), ORACLES[name])


def test_every_operator_has_a_query():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


def test_quality_is_learnt(spark, sf_dir):
    found = {r.doc_id: r for r in QUERIES["op2_quality"](spark, sf_dir).collect()}
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    right = [found[r.doc_id].predicted == r.quality for r in labels if found[r.doc_id].held_out]
    assert sum(right) >= 0.9 * len(right) > 0


def test_bpe_equals_the_library(spark, sf_dir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    found = {r.doc_id: r for r in QUERIES["op4_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        row = found[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_token_counts_equal_the_library(spark, sf_dir):
    own = token_counts.encoder(tokenizer_file("byte_bpe_50k.tiktoken"))
    wanted = {r.doc_id: len(own.encode_ordinary(r.text or "")) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in QUERIES["op7_token_counts"](spark, sf_dir).collect()} == wanted


def test_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    """Every stage's decisions, recomputed plainly on its own input."""
    from test_llm_fuzzy_lines import plain_dedup
    from test_llm_jaccard import plain_components

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], sf_dir).write.parquet(f"{tmp_path}/{i}")
        tables.append(spark.read.parquet(f"{tmp_path}/{i}"))
    assert all(t.columns == columns for t in tables[:5])
    rows = [{r.doc_id: r for r in t.collect()} for t in tables]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [i for i in rows[0] if labels.get(i) == 1]
    assert sum(i in rows[1] for i in good) >= 0.95 * len(good)
    bad = [i for i in rows[0] if labels.get(i) == 0]
    assert sum(i in rows[1] for i in bad) <= 0.1 * len(bad)
    texts = plain_dedup({i: r.text for i, r in rows[1].items()})
    assert {i: r.text for i, r in rows[2].items()} == {i: t for i, t in texts.items() if t == rows[1][i].text or t.strip()}
    groups = plain_components({i: r.text for i, r in rows[2].items()})
    assert set(rows[3]) == {i for i, low in groups.items() if i == low}
    dirty = {r.doc_id for r in corpus_pipeline.decontaminate.contamination(tables[3], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").collect()}
    assert set(rows[4]) == set(rows[3]) - dirty
    assert {i: r.n_tokens for i, r in rows[5].items()} == {i: len(r.ids) for i, r in rows[5].items()}
    assert set(rows[5]) == set(rows[4])
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf_dir).collect()} == {i: r.ids for i, r in rows[5].items()}


def test_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "benchmark", "labels", "conversations", "pages", "embeddings"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in QUERIES.items():
        assert query(spark, str(tmp_path)).count() == (1 if name == "op3_chat_formatting" else 0), name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
