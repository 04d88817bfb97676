"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm import alignment, bpe, forest, gam, lexical, lines, lm, packing, repeats, rules, secret_scan, tokenfile, topk
from trackmart.llm.common import table
from trackmart.runtime import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def remainder(n: int) -> Column:
    """Checksum of the document's id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query
def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("quality").alias("label"))
    scored = gam.classify(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out, "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents"))


ORACLES["op3_quality_rules"] = rules.oracle_sql()


@query
def op4_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


ORACLES["op4_pivot_top_k"] = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.x, v.x), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored QUALIFY rank <= 5"""


@query
def op5_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"), remainder(7) == 2)


@query
def op6_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.jaccard_join(table(spark, sf_dir, "documents"))


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    counts = [secret_scan.counted(F.col("spans"), kind).alias(f"n_{kind}") for kind in secret_scan.KINDS]
    base = secret_scan.listed(F.col("spans"), secret_scan.BASE_KINDS)
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 0, path)
    return tokenfile.read_tokens(spark, path, with_ids=False)


@query
def op10_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("runs").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


ORACLES["op11_best_position"] = """
    WITH d AS (
        SELECT row_number() OVER () AS row_id, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS terms
        FROM documents),
    b AS (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
        FROM benchmark),
    asked AS (SELECT item_id, term, count(*) AS times FROM b GROUP BY ALL),
    size AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, sum(len(terms))::BIGINT AS total FROM d),
    held AS (
        SELECT row_id, doc_id, len(terms) AS n, term, count(*) AS tf
        FROM (SELECT row_id, doc_id, terms, unnest(terms) AS term FROM d) SEMI JOIN asked USING (term) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, size GROUP BY term),
    scored AS (
        SELECT item_id, row_id, doc_id,
               sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
        FROM held JOIN w USING (term) JOIN asked USING (term), size GROUP BY ALL)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 10"""


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.drop_frequent_lines(table(spark, sf_dir, "documents"), min_documents=10, min_chars=1)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op12_line_dedup"] = """
    WITH l AS (
        SELECT row_id, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
        FROM (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
    k AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
    marked AS (SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often USING (key))
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY row_id"""


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align_tokens(table(spark, sf_dir, "documents"), *files)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
