"""The pipeline's stages on sf0.001 with planted cases, each against brute force on its own input."""

import duckdb
import corpus_pipeline
from conftest import SMOKE
from helpers import near_components
from tokenizers import Tokenizer

import public_tokenizers
from recspark.llm.common import documents
from recspark.session import materialize


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    extra = [(10_001, "Привет мир как дела сегодня", "ru", "src0", 27), (10_002, None, None, None, None), (10_003, "12 34", "en", "src1", 5)]
    docs = documents(spark, SMOKE)
    cols = docs.columns
    # foreign text without a label: the classifier has not learned its language
    docs = materialize(docs.unionByName(spark.createDataFrame(extra, docs.schema)).replace({"ru": None}, subset=["lang"]), "planted")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SMOKE), name)
        assert name == "packing" or docs.columns == cols
        seen.append(docs)
    rows = [[(r.doc_id, r.text) for r in d.collect()] for d in seen[:-1]]
    first, known, single, apart, mixed = rows
    assert {i for i, _ in first} - {i for i, _ in known} == {10_001, 10_002, 10_003}
    groups = {}
    for i, t in known:
        groups.setdefault(t, []).append(i)
    assert sorted(i for i, _ in single) == sorted(max(g) for g in groups.values())
    comp = near_components(single)
    assert sorted(i for i, _ in apart) == sorted(i for i, (_, c) in comp.items() if c == i)
    assert {i for i, _ in mixed} == {i for i, _ in apart}  # nothing is lost, small sources repeat
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    want = sum(len(tok.encode(t, add_special_tokens=False).ids) + 1 for _, t in mixed)
    packed = seen[-1].groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in packed) == want and max(r[1] for r in packed) <= 2048


def test_run(spark):
    out = corpus_pipeline.run(spark, SMOKE)
    n = duckdb.sql(f"SELECT count(DISTINCT text) FROM '{SMOKE}/documents.parquet'").fetchall()[0][0]
    assert 0 < out.select("doc_id").distinct().count() <= n
