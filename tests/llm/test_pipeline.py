import corpus_pipeline
from dumpmill.llm import bpe, queries
from tests.llm.helpers import documents, empty


def test_stages_keep_the_columns(spark, sf_dir, tmp_path):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert stage(spark, empty(spark), sf_dir).count() == 0, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    back = bpe.decode(coded, queries.tokenizer("byte_bpe_multi_50k.tiktoken"))
    assert sorted((r.doc_id or -1, bytes(r.decoded).decode()) for r in back.collect()) == sorted((r.doc_id or -1, r.text or "") for r in docs.collect())


def test_run_is_its_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(docs.count())
    got = corpus_pipeline.run(spark, sf_dir)
    key = lambda df: sorted((r.doc_id, r.n_tokens, tuple(r.token_ids)) for r in df.collect())
    assert key(got) == key(docs) and 0 < counts[1] < counts[0] and counts[3] <= counts[2] <= counts[1]


def test_every_query_is_registered():
    assert [n for n in queries.QUERIES] == [
        "op1_quality_resampling", "op2_line_dedup", "op3_quality_rules", "op4_token_counts", "op5_byte_bpe", "op6_license_scan", "op7_vector_dedup", "op8_mix_sources",
        "op9_simhash_groups", "op10_secret_scan", "op11_ranked_search", "op12_conversation_repair", "op13_harmonic_packing", "pipeline"]
