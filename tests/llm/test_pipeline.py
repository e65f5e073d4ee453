import base64

import pytest
import tiktoken

import corpus_pipeline
import public_tokenizers
from edge import TEXTS, edge_docs, labels
from test_decontaminate import brute as benchmark_hits
from test_near_dup import components, fingerprint
from test_secrets_scan import brute as secrets
from vecframe.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Each stage on what its predecessor kept."""
    from vecframe.llm import quality
    from vecframe.llm.common import read_table
    docs = read_table(spark, SF, "documents").cache()
    bench = [(str(r.item_id), r.text) for r in read_table(spark, SF, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, SF)
    assert good.columns == docs.columns
    chosen = {r.doc_id for r in quality.resample(docs, read_table(spark, SF, "labels")).where("kept").collect()}
    kept = {r.doc_id: r for r in good.collect()}
    assert set(kept) == chosen

    roots = components({i: fingerprint(r.text) for i, r in kept.items()})
    single = {r.doc_id: r for r in stages["near_dedup"](spark, spark.createDataFrame(list(kept.values()), docs.schema), SF).collect()}
    assert set(single) == set(roots.values())

    clean = {r.doc_id: r for r in stages["decontamination"](spark, spark.createDataFrame(list(single.values()), docs.schema), SF).collect()}
    assert set(clean) == {i for i, r in single.items() if not benchmark_hits(r.text, bench)[1]}

    bare = {r.doc_id: r for r in stages["secrets"](spark, spark.createDataFrame(list(clean.values()), docs.schema), SF).collect()}
    assert set(bare) == set(clean) and not any(secrets(r.text) for r in bare.values())
    assert all(bare[i].text == r.text for i, r in clean.items() if "[SECRET]" not in bare[i].text)

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = stages["byte_bpe"](spark, spark.createDataFrame(list(bare.values()), docs.schema), SF).collect()
    assert {r.doc_id: list(r.ids) for r in coded} == {i: library.encode_ordinary(r.text) for i, r in bare.items()}


def test_run_is_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    key = lambda df: sorted((r.doc_id, r.ids_sha256) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(docs)


@pytest.mark.parametrize("texts", [TEXTS, []])
def test_stages_on_edge_tables(spark, tmp_path, texts):
    labels(spark, [(1, 1, 0), (6, 0, 0)]).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = edge_docs(spark, texts)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            assert out.count() <= len(texts)


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())
