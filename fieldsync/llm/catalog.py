"""The registered queries of this package, with production parameters, and their SQL where SQL can tell them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldsync.llm import alignment, bpe, hard_negatives, html_text, kmeans_tree, lm_bloom, mixing, quality, revisits, runindex, superkmers, toxicity, vptree
from fieldsync.llm.batches import ship_code

#: The tokenizer file of the registered queries; a parameter of the operator.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The model that its tokens are aligned with.
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bpe.encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER)
    return made.select(
        "doc_id",
        F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("coded.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    lexicon = toxicity.learned(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = toxicity.scored(docs, lexicon)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_pfair(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.scheduled(docs, mixing.tempered_weights(docs)).select("doc_id", "source", "mix.*")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as captures of the indexes they lie in: every third one a revisit, the others responses."""
    i = F.col("page_id")
    revisit = i % 3 == 0
    version = F.expr("page_id div 50").cast("string")
    headers = F.when(
        revisit,
        F.map_concat(
            F.create_map(F.lit("Date"), i.cast("string"), F.lit("Content-Length"), F.lit("0")),
            F.when(i % 4 == 0, F.create_map(F.lit("ETag"), F.concat(F.lit('W/"'), version, F.lit('"'))))
            .when(i % 4 == 1, F.create_map(F.lit("last-modified"), version))
            .otherwise(F.create_map().cast("map<string,string>")),
        ),
    ).otherwise(
        F.create_map(
            F.lit("date"), i.cast("string"), F.lit("etag"), F.concat(F.lit('"'), version, F.lit('"')), F.lit("Last-Modified"), version,
            F.lit("content-length"), F.octet_length("html").cast("string"),
        )
    )
    return table(spark, sf_dir, "pages", "page_id", "url", "html").select(
        i.alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.regexp_replace("url", "/[0-9]+", "/index").alias("url"),
        (i * 60).alias("at"),
        F.when(revisit, 304).when(i % 11 == 0, 404).otherwise(200).alias("status"),
        headers.alias("headers"),
        F.when(~revisit | (i % 4 == 2), F.md5("html")).alias("digest"),
    )


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolved(captures(spark, sf_dir))
    return found.select("record_id", "url", "outcome", "target_id", "digest", revisits.header_text(F.col("headers")).alias("headers"))


def op6_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vptree.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", vptree.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op7_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return kmeans_tree.neighbours(vectors, F.col("vec_id") % 100 == 0)


def op8_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = superkmers.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "removal.n_words", "removal.n_removed", F.sha2("removal.kept", 256).alias("kept_sha256"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.with_main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_runindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = runindex.remove_matches(table(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "removal.n_bytes", "removal.n_removed", "removal.n_spans", F.sha2("removal.kept", 256).alias("kept_sha256"))


def op11_lm_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = lm_bloom.fitted(docs.where(~lm_bloom.held_out(F.col("doc_id"))))
    scored = lm_bloom.scored(docs, model)
    return scored.select("doc_id", lm_bloom.held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(vectors, F.col("vec_id") % 100 == 0, label=label)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = alignment.aligned(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER, PIECES)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    made = made.withColumn("groups_sha256", digest).drop("groups")
    counted = alignment.with_counts(made, alignment.pieces_of(PIECES))
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_line_frequency": op3_line_frequency,
    "op4_pfair": op4_pfair,
    "op5_revisits": op5_revisits,
    "op6_vptree": op6_vptree,
    "op7_kmeans_tree": op7_kmeans_tree,
    "op8_superkmers": op8_superkmers,
    "op9_html_text": op9_html_text,
    "op10_runindex": op10_runindex,
    "op11_lm_bloom": op11_lm_bloom,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {
    "op3_line_frequency": f"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + {quality.WINDOW - 1}], ' ') AS run
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {quality.WINDOW - 2})) AS i FROM docs WHERE len(words) >= {quality.WINDOW})
), again AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1
), covered AS (
    SELECT doc_id, sum(least({quality.WINDOW}, coalesce(following - i, {quality.WINDOW}))) AS n
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM again) GROUP BY 1
), lines AS (
    SELECT doc_id, host, raw, regexp_extract_all(raw, '[^\\x20\\x09-\\x0D]+') AS words
    FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS raw FROM docs)
    WHERE regexp_matches(raw, '[^\\x20\\x09-\\x0D]')
), hashed AS (
    SELECT doc_id, host, raw, len(words) AS n, substr(md5(lower(array_to_string(words, ' '))), 1, 16) AS line FROM lines
), held AS (
    SELECT d.doc_id, any_value(d.host) AS host, coalesce(list_sort(list(DISTINCT line) FILTER (line IS NOT NULL)), []) AS ordered,
        count(raw) - count(DISTINCT raw) AS n_dup
    FROM docs d LEFT JOIN hashed h USING (doc_id) GROUP BY d.doc_id
), apart AS (
    SELECT DISTINCT host, ordered FROM held
), frequent AS (
    SELECT host, line FROM (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(ordered) AS line FROM apart) GROUP BY 1, 2)
    JOIN (SELECT host, count(*) AS n_host FROM apart GROUP BY 1) USING (host)
    WHERE n >= {quality.LINE_DOCUMENTS} AND 100 * n >= {quality.LINE_SHARE} * n_host
), removed AS (
    SELECT doc_id, sum(n) AS n FROM hashed JOIN frequent USING (host, line) GROUP BY 1
), counted AS (
    SELECT d.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(h.n_dup, 0) AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(r.n, 0) AS gone
    FROM docs d LEFT JOIN held h USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN removed r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.REPEATED} * n_words AS base_failed,
    NOT (n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.REPEATED} * n_words)
        AND 100 * (n_words - gone) >= {quality.LEFT} * n_words AS kept
FROM counted
""",
    "op4_pfair": f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, coalesce(source, '') AS s, greatest(1, coalesce(strlen(text), 0)) AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h, md5(text) AS m
    FROM documents
), sized AS (
    SELECT s, greatest(1, floor(sqrt(sum(size)::DOUBLE))::BIGINT) AS weight, ((sum(size) + {mixing.BLOCK - 1}) // {mixing.BLOCK})::BIGINT AS n FROM docs GROUP BY 1
), listed AS (
    SELECT list(weight ORDER BY s) AS w, list(n ORDER BY s) AS n, sum(weight)::BIGINT AS total, sum(n)::BIGINT AS blocks FROM sized
), ran AS (
    SELECT 0::BIGINT AS step, -1::BIGINT AS t, list_transform(w, lambda x: 0::BIGINT) AS following, NULL::BIGINT AS source, NULL::BIGINT AS block FROM listed
    UNION ALL
    SELECT step + 1, best.slot, list_transform(following, lambda x, i: CASE WHEN i = best.i THEN x + 1 ELSE x END), best.i, following[best.i]
    FROM (
        SELECT step, following, list_min(list_filter(list_transform(w, lambda x, i: CASE WHEN following[i] < n[i] THEN
            {{'slot': greatest(following[i] * total // x, t + 1), 'deadline': ((following[i] + 1) * total + x - 1) // x, 'i': i}} END), lambda x: x IS NOT NULL)) AS best
        FROM ran, listed WHERE step < blocks
    )
), sources AS (
    SELECT s, weight, row_number() OVER (ORDER BY s) AS i FROM sized
), placed AS (
    SELECT doc_id, source, s, coalesce(sum(size) OVER (PARTITION BY s ORDER BY h, doc_id NULLS FIRST, m NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM docs
)
SELECT doc_id, p.source, p.begins // {mixing.BLOCK} AS block, p.begins // {mixing.BLOCK} * total // weight AS release,
    ((p.begins // {mixing.BLOCK} + 1) * total + weight - 1) // weight AS deadline, r.t AS slot, p.begins % {mixing.BLOCK} AS place
FROM placed p JOIN sources USING (s) JOIN ran r ON r.source = i AND r.block = p.begins // {mixing.BLOCK}, listed
""",
    "op5_revisits": r"""
WITH captures AS (
    SELECT page_id AS i, page_id % 3 = 0 AS revisit, (page_id // 50)::VARCHAR AS v, md5(html) AS digest, strlen(html) AS size,
        regexp_replace(regexp_replace(regexp_replace(url, '/[0-9]+', '/index', 'g'), '#.*$', ''), '^[A-Za-z]+://', '') AS u
    FROM pages
), parts AS (
    SELECT *, regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^www\d*\.', '') AS host, regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
        list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|fbclid|gclid)(=|$)'))) AS q
    FROM captures
), named AS (
    SELECT *, host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url FROM parts
), joined AS (
    SELECT r.*, f.i AS target, f.v AS fv, f.digest AS fdigest, f.size AS fsize
    FROM (SELECT * FROM named WHERE revisit) r ASOF LEFT JOIN (SELECT * FROM named WHERE NOT revisit AND i % 11 <> 0) f ON r.url = f.url AND r.i > f.i
), judged AS (
    SELECT *, CASE WHEN target IS NULL THEN 'no_response' WHEN i % 4 = 3 THEN 'no_validator'
        WHEN CASE WHEN i % 4 = 2 THEN digest = fdigest ELSE v = fv END THEN 'resolved' ELSE 'differs' END AS outcome
    FROM joined
)
SELECT i AS record_id, url, outcome, CASE WHEN outcome = 'resolved' THEN target END AS target_id, CASE WHEN outcome = 'resolved' THEN fdigest END AS digest,
    CASE WHEN outcome = 'resolved' THEN 'content-length: ' || fsize || chr(10) || 'date: ' || i || chr(10) || 'etag: '
        || CASE WHEN i % 4 = 0 THEN 'W/' ELSE '' END || '"' || fv || '"' || chr(10) || 'last-modified: ' || fv END AS headers
FROM judged
""",
}
