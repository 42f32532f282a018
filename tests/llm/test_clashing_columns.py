"""Further columns whose names differ from those that are read in case alone make no difference."""

import pytest
from public_tokenizers import PATTERN
from pyspark.sql import functions as F

import corpus_pipeline
from brickrow.llm import bpe, collocations, exact_dedup, filter_audit, jaccard_join, main_text, packing, phrases, quality_classifier, quality_rules, secret_scan, token_store, toxicity
from brickrow.llm.common import shared_path
from brickrow.llm.queries import RANKS, TOKENIZER

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    """``documents``, ``labels`` and ``pages``, plain and with clashing columns."""
    plain = {name: spark.read.parquet(f"{SF}/{name}.parquet").limit(60) for name in ("documents", "labels", "pages")}
    clashing = {}
    for name, table in plain.items():
        added = [c.upper() for c in table.columns]
        wide = table.select("*", *[F.lit("other").alias(f"x{i}") for i in range(len(added))])
        clashing[name] = wide.toDF(*table.columns, *added)
    return plain, clashing


OPERATORS = {
    "token_store": lambda s, t: token_store.checksums(token_store.documents(s, token_store.write(t["documents"], shared_path(s, "t"), TOKENIZER))),
    "jaccard_join": lambda s, t: jaccard_join.classes(t["documents"]),
    "secret_scan": lambda s, t: secret_scan.scan(t["documents"], secret_scan.fit(t["documents"])),
    "bpe": lambda s, t: bpe.round_trip(t["documents"], RANKS, PATTERN),
    "quality_classifier": lambda s, t: quality_classifier.classify(t["documents"], quality_classifier.fit(t["documents"], t["labels"])),
    "packing": lambda s, t: packing.pack(t["documents"], TOKENIZER),
    "phrases": lambda s, t: phrases.compare_edits(t["documents"]),
    "toxicity": lambda s, t: toxicity.classify(t["documents"], toxicity.fit(t["documents"], t["labels"])),
    "quality_rules": lambda s, t: quality_rules.judge(t["documents"]),
    "main_text": lambda s, t: main_text.extract(t["pages"], main_text.fit(t["pages"])),
    "exact_dedup": lambda s, t: exact_dedup.judge(t["documents"]),
    "collocations": lambda s, t: collocations.mine(t["documents"], least=3),
    "filter_audit": lambda s, t: filter_audit.audit(t["documents"], t["labels"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators(spark, tables, name):
    rows = [sorted(map(repr, OPERATORS[name](spark, t).collect())) for t in tables]
    if name == "packing":  # numbers of sequences are any
        assert len(rows[0]) == len(rows[1])
    else:
        assert rows[0] == rows[1]


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[2:4]], ids=[n for n, _ in corpus_pipeline.STAGES[2:4]])
def test_stages(spark, tables, stage):
    plain, clashing = tables
    wide = stage(spark, clashing["documents"], SF)
    assert wide.columns == clashing["documents"].columns
    n = len(plain["documents"].columns)
    cut = sorted(repr(tuple(r)[:n]) for r in wide.collect())
    assert cut == sorted(repr(tuple(r)) for r in stage(spark, plain["documents"], SF).collect())
