import corpus_pipeline as cp
from textloom.llm import minhash, queries
from textloom.llm.pii_spans import base_spans

DATA = "/root/testdata/sf0.001"


def test_stages_work_on_what_is_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", None, None), (9002, "123 456", None, "s", 1), (None, docs.first()["text"], None, "s", 2)], docs.schema)
    current = docs.unionByName(odd)
    columns = current.columns
    seen = {}
    for name, stage in cp.STAGES:
        out = stage(spark, current, DATA)
        out.write.parquet(str(tmp_path / name))
        before, current = current, spark.read.parquet(str(tmp_path / name))
        seen[name] = current
        if name != cp.STAGES[-1][0]:
            assert current.columns == columns
        if name in ("language_id", "minhash_near_dedup"):
            assert 0 < current.count() < before.count()
        if name == "pii":
            assert current.count() == before.count()
    ids = {r["doc_id"] for r in seen["language_id"].collect()}
    assert not ids & {9001, 9002} and None in ids
    # the copy without an id goes with the others of its class
    assert None not in {r["doc_id"] for r in seen["minhash_near_dedup"].collect()}
    classes = minhash.near_duplicate_classes(seen["language_id"]).collect()
    kept = [r["doc_id"] for r in seen["minhash_near_dedup"].collect() if r["doc_id"] is not None]
    assert sorted(kept) == sorted({r["class_id"] for r in classes if r["class_id"] is not None})
    assert not any(base_spans(r["text"]) for r in seen["pii"].collect())
    mixed = seen["mixing"].groupBy("doc_id").count().collect()
    assert max(r["count"] for r in mixed) <= 3
    assert seen["sentencepiece"].count() == seen["mixing"].count()
    assert seen["sentencepiece"].filter("not round_trip").count() == 0


def test_clean_documents_pass_the_language_stage(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").filter("length(text) > 200")
    kept = cp.keep_language(spark, docs, DATA)
    assert kept.count() >= 0.98 * docs.count()


def test_run_and_registration(spark):
    assert len(cp.run(spark, DATA).columns) == 4
    assert sorted(queries.all_queries()) == sorted([*(f"op{i}_{n}" for i, n in [
        (1, "minhash_near_dedup"), (2, "chat_formatting"), (3, "ann_posting_lists"), (4, "html_layout"), (5, "pii_tagger"),
        (6, "sentencepiece"), (7, "pivot_topk"), (8, "language_mixture"), (9, "range_shards"), (10, "pivotal_mix"),
        (11, "benchmark_decontamination"), (12, "importance_resampling"), (13, "periodic_runs")]), "pipeline"])
