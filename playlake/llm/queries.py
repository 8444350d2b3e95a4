"""The operators over the given tables, one query each, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from playlake.llm import (
    decontamination,
    importance,
    licenses,
    lm_scoring,
    near_dedup,
    pieces,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    token_counts,
    token_files,
    url_filter,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judged(pages, url_filter.unwanted_hosts(pages))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.judged(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), WORD_MODEL)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digested(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.judged(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.grouped(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.listed(table(spark, sf_dir, "documents"), WORD_MODEL)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def registered() -> dict[str, Query]:
    ops = (
        op1_quality_rules,
        op2_decontamination,
        op3_quality_classifier,
        op4_lm_scoring,
        op5_url_filters,
        op6_suffix_dedup,
        op7_token_counts,
        op8_sentencepiece,
        op9_license_scans,
        op10_near_dedup,
        op11_whitening,
        op12_token_files,
        op13_importance,
        pipeline,
    )
    return {op.__name__: op for op in ops}


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))

OP1 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT r, doc_id, text,
    regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) > 2)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), measures AS (
  SELECT split.doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: x IN ({_STOPS}))) AS stops,
    len(lines) AS n_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^ *[-*•]') OR x LIKE '%...' OR x LIKE '%…')) AS marked
  FROM split LEFT JOIN covered USING (r)
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 20.0 AND n_symbols / n_words <= 0.1
  AND stops / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.5 AND marked / n_lines <= 0.9 AS kept
FROM failed
"""

OP2 = r"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), windows AS (
  SELECT DISTINCT item, least(len(words), 13) AS size,
    array_to_string(words[i:i + least(len(words), 13) - 1], ' ') AS w
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM items WHERE len(words) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT r, size, i, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM docs, sizes WHERE len(words) >= size)
), hits AS (
  SELECT r, i, places.size, item FROM places JOIN windows ON places.w = windows.w AND places.size = windows.size
), covered AS (
  SELECT r, count(DISTINCT place) AS n FROM (
    SELECT r, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT r, i, size FROM hits)) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit,
  coalesce(named.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

_UNWANTED = "|".join(url_filter.UNWANTED)

OP5 = rf"""
WITH cut AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
    END AS rule, regexp_matches(host, '{_UNWANTED}') AS listed
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM ruled
"""


# crc32 of a word: its bytes, one after the other, through the table of the polynomial.
OP13 = rf"""
WITH steps AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, ignored: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), items AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM benchmark
), counted AS (
  SELECT r, w, count(*) AS n FROM (SELECT r, unnest(words) AS w FROM docs) GROUP BY r, w
), vocabulary AS (
  SELECT w, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(w))),
        lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % {importance.BUCKETS} AS bucket
  FROM (SELECT w FROM counted UNION SELECT w FROM items), steps
), source AS (
  SELECT bucket, sum(n)::BIGINT AS s FROM counted JOIN vocabulary USING (w) GROUP BY bucket
), target AS (
  SELECT bucket, count(*) AS t FROM items JOIN vocabulary USING (w) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(
      ((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM source) + {importance.BUCKETS}))::DOUBLE
      / ((coalesce(s, 0) + 1) * ((SELECT sum(t) FROM target) + {importance.BUCKETS}))::DOUBLE))::BIGINT AS gain
  FROM source FULL JOIN target USING (bucket)
), weights AS (
  SELECT r, sum(n * gain)::BIGINT AS weight FROM counted JOIN vocabulary USING (w) JOIN gains USING (bucket) GROUP BY r
), scored AS (
  SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('{importance.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (r)
), places AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, r) AS place
  FROM scored WHERE n_features >= {importance.LEAST_WORDS}
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT {importance.PERCENT} * count(*) // 100 FROM places) THEN place END AS rank
FROM scored LEFT JOIN places USING (r)
"""


def statements() -> dict[str, str]:
    """SQL of the queries that it can say: models, library ids and graph steps have none."""
    return {"op1_quality_rules": OP1, "op2_decontamination": OP2, "op5_url_filters": OP5, "op13_importance": OP13}
