import corpus_pipeline
from brickrow.llm.common import in_order, keep_rows
from brickrow.llm.jaccard_join import classes
from brickrow.llm.queries import ORACLES, QUERIES
from tests.llm.test_packing import assert_packed

SF = "/root/testdata/sf0.01"


def test_stages_and_queries():
    assert [n.partition("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(ORACLES) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_classifier", "ngram_jaccard_join", "secret_scans", "best_fit_packing"]


def test_every_stage_takes_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        counts.append(docs.count())
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert counts == sorted(counts, reverse=True) and counts[3] == counts[4]
    clean = {d for d, r in labels.items() if not r.toxic}
    assert len(clean & kept["toxicity"]) >= 0.98 * len(clean)
    good = {d for d, r in labels.items() if r.quality and d in kept["toxicity"]}
    assert len(good & kept["quality_classifier"]) >= 0.97 * len(good)
    groups = classes(spark.read.parquet(str(tmp_path / "ngram_jaccard_join"))).collect()
    assert len({r.component_id for r in groups}) == len(groups)
    first = {r.component_id for r in classes(spark.read.parquet(str(tmp_path / "quality_classifier"))).collect()}
    assert first == kept["ngram_jaccard_join"]
    changed = docs.where("contains(text, '[SECRET]')")
    assert changed.count() > 0 and changed.where("n_chars <> char_length(text)").count() == 0
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert_packed(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_odd_and_no_documents(spark, odd_docs, no_docs, tmp_path):
    for k, docs in enumerate((odd_docs.select("doc_id", "text", "lang", "source", "n_chars"), no_docs.select("doc_id", "text", "lang", "source", "n_chars"))):
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{k}{name}")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == (k == 0)


def test_rows_in_global_order(odd_docs):
    for ahead in (False, True):
        rows = in_order(odd_docs, ahead).rows.collect()
        ids = [r.doc_id for r in rows if not r.ahead]
        assert ids == sorted(ids, key=lambda x: (x is not None, x or 0)) and len(ids) == odd_docs.count()
        assert any(r.ahead for r in rows) == ahead


def test_keeping_rows_keeps_columns(odd_docs):
    kept = keep_rows(odd_docs, lambda: lambda texts: [len(t) > 10 for t in texts])
    assert kept.dtypes == odd_docs.dtypes
    assert kept.count() == odd_docs.where("length(text) > 10").count()
