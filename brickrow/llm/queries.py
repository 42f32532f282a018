"""One query for each operator, over its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickrow.llm import bpe, collocations, exact_dedup, filter_audit, jaccard_join, main_text, packing, phrases, quality_classifier, quality_rules, secret_scan, token_store, toxicity
from brickrow.llm.common import shared_path, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.write(table(spark, sf_dir, "documents"), shared_path(spark, "tokens"), TOKENIZER)
    return token_store.checksums(token_store.documents(spark, path))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_digests(secret_scan.scan(docs, secret_scan.fit(docs)))


def secret_digests(scanned: DataFrame) -> DataFrame:
    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x.kind != "crf")
    return scanned.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.round_trip(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.classify(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.compare_edits(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("lang", "source")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_text.extract(pages, main_text.fit(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.judge(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": op1_token_store,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_secret_scan": op3_secret_scan,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op10_main_text": op10_main_text,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_collocations": op12_collocations,
    "op13_filter_audit": op13_filter_audit,
}

#: Words as the operators take them: runs of anything but the six ASCII white-space characters.
_WORDS = "[^\\x20\\x09-\\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op2_jaccard_join": f"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE [w[i:i + 4] FOR i IN range(1, len(w) - 3)] END) AS s
  FROM words
), numbered AS MATERIALIZED (
  SELECT r, dense_rank() OVER (ORDER BY s) AS s FROM sets
), sizes AS MATERIALIZED (
  SELECT r, count(*) AS n FROM numbered GROUP BY r
), links AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.r AS a, y.r AS b, count(*) AS c FROM numbered x JOIN numbered y ON x.s = y.s AND x.r <> y.r GROUP BY ALL
  ) p JOIN sizes u ON u.r = p.a JOIN sizes v ON v.r = p.b
  WHERE 100 * c >= 75 * (u.n + v.n - c)
), keyed AS MATERIALIZED (
  SELECT r, dense_rank() OVER (ORDER BY k) AS k FROM (SELECT r, list_sort(list(s)) AS k FROM numbered GROUP BY r)
), counted AS (
  SELECT links.a AS r, count(DISTINCT y.k) AS n_links FROM links JOIN keyed x ON x.r = links.a JOIN keyed y ON y.r = links.b WHERE x.k <> y.k GROUP BY links.a
), reach AS (
  SELECT r AS a, r AS b FROM words
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT words.doc_id, coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(other.doc_id) AS component_id,
  coalesce(any_value(counted.n_links), 0)::BIGINT AS n_links
FROM words JOIN reach ON reach.a = words.r JOIN words other ON other.r = reach.b LEFT JOIN sizes ON sizes.r = words.r
LEFT JOIN counted ON counted.r = words.r
GROUP BY words.r, words.doc_id
""",
    "op9_quality_rules": f"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w
  FROM documents
), windows AS (
  SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM texts)
), again AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r
), measured AS MATERIALIZED (
  SELECT texts.r, doc_id, lang, source, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS full_lines FROM texts) texts
  LEFT JOIN repeated ON repeated.r = texts.r
), judged AS MATERIALIZED (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), valued AS MATERIALIZED (
  SELECT r, lang, source, base_failed, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) AS measure,
    unnest([word_chars, n_symbols, n_dup_lines, n_repeat_words]) * 1000 // greatest(n_words, 1) AS v
  FROM judged
), sketch AS MATERIALIZED (
  SELECT lang, source, measure, CASE WHEN v < 1 THEN 0 ELSE floor(ln(v) / ln({quality_rules.GROWTH}::DOUBLE)) + 1 END::INTEGER AS b, count(*) AS n
  FROM valued WHERE NOT base_failed GROUP BY ALL
), ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, measure) AS total,
    sum(n) OVER (PARTITION BY lang, source, measure ORDER BY b) AS upto FROM sketch
), merged AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, measure) AS total, sum(n) OVER (PARTITION BY lang, measure ORDER BY b) AS upto
  FROM (SELECT lang, measure, b, sum(n) AS n FROM sketch GROUP BY ALL)
), own AS (
  SELECT lang, source, measure, max(total) AS total, min(b) FILTER (upto >= 0.25 * total) AS b1, min(b) FILTER (upto >= 0.75 * total) AS b3
  FROM ranked GROUP BY ALL
), whole AS (
  SELECT lang, measure, min(b) FILTER (upto >= 0.25 * total) AS b1, min(b) FILTER (upto >= 0.75 * total) AS b3 FROM merged GROUP BY ALL
), quartiles AS (
  SELECT own.lang, own.source, own.measure,
    CASE WHEN x1 < 1 THEN 0 ELSE 2 * pow({quality_rules.GROWTH}::DOUBLE, x1) / {quality_rules.GROWTH + 1}::DOUBLE END AS q1,
    CASE WHEN x3 < 1 THEN 0 ELSE 2 * pow({quality_rules.GROWTH}::DOUBLE, x3) / {quality_rules.GROWTH + 1}::DOUBLE END AS q3
  FROM (
    SELECT own.*, CASE WHEN total >= {quality_rules.LEAST} THEN own.b1 ELSE whole.b1 END AS x1,
      CASE WHEN total >= {quality_rules.LEAST} THEN own.b3 ELSE whole.b3 END AS x3
    FROM own JOIN whole ON own.lang IS NOT DISTINCT FROM whole.lang AND own.measure = whole.measure
  ) own
), fences AS (
  SELECT *, greatest({quality_rules.SPREAD} * (q3 - q1), CASE measure WHEN 'word_length' THEN 2000 WHEN 'symbols' THEN 100 WHEN 'dup_lines' THEN 60 ELSE 250 END) AS wide
  FROM quartiles
), outside AS (
  SELECT DISTINCT valued.r FROM valued JOIN fences
    ON valued.lang IS NOT DISTINCT FROM fences.lang AND valued.source IS NOT DISTINCT FROM fences.source AND valued.measure = fences.measure
  WHERE v > q3 + wide OR (fences.measure = 'word_length' AND v < q1 - wide)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM outside) AS kept
FROM judged
""",
    "op11_exact_dedup": """
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM texts WINDOW w AS (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST, r)
""",
    "op12_collocations": f"""
WITH pieces AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), grams AS MATERIALIZED (
  SELECT lang, size, w[i:i + size - 1] AS g, count(*) AS f
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM (SELECT *, unnest([1, 2, 3, 4]) AS size FROM pieces))
  GROUP BY ALL HAVING count(*) >= {collocations.LEAST_COUNT}
), covered AS (
  SELECT DISTINCT s.lang, s.g FROM (
    SELECT lang, f, g[i:i + size - 1] AS g FROM (
      SELECT *, unnest(range(1, long - size + 2)) AS i FROM (SELECT lang, f, g, size AS long, unnest(range(2, size)) AS size FROM grams WHERE size > 2)
    )
  ) t JOIN grams s ON s.lang = t.lang AND s.g = t.g WHERE 100 * t.f::HUGEINT >= {collocations.COVERED} * s.f::HUGEINT
), cuts AS (
  SELECT c.lang, c.g, c.f AS a, c.k, x.f AS l, y.f AS r, ({collocations.SCALE} * c.f::HUGEINT) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM grams WHERE size > 1) c
  JOIN grams x ON x.lang = c.lang AND x.g = c.g[1:c.k] JOIN grams y ON y.lang = c.lang AND y.g = c.g[c.k + 1:c.size]
), best AS (
  SELECT * FROM cuts ANTI JOIN covered USING (lang, g) QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase FROM best
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang)
QUALIFY rank <= {collocations.TOP}
""",
    "op13_filter_audit": f"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents
), marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), least AS (
  SELECT t, min(doc_id) AS low FROM texts GROUP BY t
), failed AS MATERIALIZED (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN texts.doc_id > low THEN 16 ELSE 0 END AS mask
  FROM texts JOIN least USING (t) LEFT JOIN marks ON marks.doc_id = texts.doc_id
), counted AS MATERIALIZED (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY part, mask
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), walked AS (
  SELECT filter_order, step::INTEGER AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
  FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM orders)
), told AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
  FROM counted, walked GROUP BY ALL
)
SELECT * EXCLUDE bit, sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM told
""",
}
