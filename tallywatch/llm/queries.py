"""The registered queries of this package, with production parameters, and the
SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .exact_topk import exact_topk
from .jaccard_join import similar_groups
from .katz import language_scores
from .lexical_search import ranked_documents
from .license_scan import scan_licenses
from .lsh_forest import nearest
from .piece_codec import decode, encode
from .packing import pieces, place
from .periodic_runs import periodic_runs, strongest
from .quality import quality_scores
from .tables import read
from .token_files import read_token_files, write_token_files
from .toxicity import toxicity_scores
from .url_filter import Listed, judged_urls


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op4_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = decode(encode(read(spark, sf_dir, "documents"), model), model)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return place(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    files = write_token_files(read(spark, sf_dir, "documents"), path, end_id=2, vocabulary=49408)
    ids = F.col("ids")
    return read_token_files(files).select(
        "doc_id", "start", (F.octet_length(ids) / 4).cast("long").alias("n_tokens"), F.crc32(ids).alias("ids_crc32")
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(read(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


URL_RULES = [
    Listed("allow", "com", "/"),
    Listed("block", "example.com", "/en/"),
    Listed("allow", "www.example.com", "/en/"),
    Listed("block", "net", "/es/"),
    Listed("block", "net", "/fr/"),
]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(read(spark, sf_dir, "pages"), URL_RULES)


def _with_repeats(docs: DataFrame) -> DataFrame:
    """The documents, those whose id's crc32 is a multiple of ten with a periodic
    end in place of their own: from word ``a`` on, the ``p`` words there repeat."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    a, n, p = F.col("a"), F.col("n"), F.col("p")
    chosen = (
        docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
        .withColumn("words", F.when(F.col("h") % 10 == 0, words))
        .withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)})
        .withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
        .withColumn("p", (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int"))
    )
    repeated = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    ended = F.concat(F.slice("words", F.lit(1), a), F.slice(repeated, F.lit(1), n - a))
    return chosen.select("doc_id", F.when(n > 0, F.array_join(ended, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_with_repeats(read(spark, sf_dir, "documents")))
    fields, best = ("start", "length", "period"), F.col("best")
    line = lambda run: F.concat(F.concat_ws(",", *(run[name].cast("string") for name in fields)), F.lit("\n"))
    return found.withColumn("best", strongest()).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(best[name].alias(name) for name in fields),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def queries() -> dict:
    return {
        "op1_exact_topk": op1_exact_topk,
        "op2_hash_prefix_forest": op2_hash_prefix_forest,
        "op3_license_scan": op3_license_scan,
        "op4_quality_gam": op4_quality_gam,
        "op5_piece_codec": op5_piece_codec,
        "op6_katz": op6_katz,
        "op7_toxicity": op7_toxicity,
        "op8_best_fit_packing": op8_best_fit_packing,
        "op9_token_files": op9_token_files,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_ranked_search": op11_ranked_search,
        "op12_url_filter": op12_url_filter,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_topk": """
            WITH v AS (
                SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
                FROM embeddings
                WHERE embedding IS NOT NULL AND len(embedding) > 0
                  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
            s AS (
                SELECT a.vec_id AS query_id, b.vec_id,
                       CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
                FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
            SELECT query_id,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM s QUALIFY rank <= 20""",
        "op10_jaccard_join": r"""
            WITH RECURSIVE w AS (
                SELECT doc_id, list_filter(
                    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                    lambda x: x <> '') AS words
                FROM documents),
            s AS (
                SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                    ELSE list_distinct(list_transform(range(1, len(words) - 3),
                                                      lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
                FROM w),
            e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
            linked AS (
                SELECT a.doc_id AS a, b.doc_id AS b
                FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
                GROUP BY a.doc_id, b.doc_id, a.n, b.n
                HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
            reached AS (
                SELECT doc_id, doc_id AS other FROM documents
                UNION SELECT r.doc_id, l.b FROM reached r JOIN linked l ON r.other = l.a)
            SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, r.component_id
            FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r
                ON s.doc_id = r.doc_id""",
        "op11_ranked_search": r"""
            WITH d AS (
                SELECT doc_id, row_number() OVER () AS place, regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
                FROM documents),
            c AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n, sum(len(terms)) AS l FROM d),
            tf AS (
                SELECT place, doc_id, size, term, count(*) AS tf
                FROM (SELECT place, doc_id, len(terms) AS size, unnest(terms) AS term FROM d) GROUP BY ALL),
            q AS (
                SELECT item_id, term, count(*) AS times FROM (
                    SELECT item_id, unnest(regexp_extract_all(
                        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                    FROM benchmark) GROUP BY ALL),
            w AS (
                SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w
                FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
            s AS (
                SELECT item_id, doc_id, place, CAST(sum(times * w * ((1000000000 * tf)
                    // (1000 * tf + 12 * (100 - 25 + (25 * size * n) // l)))) AS BIGINT) AS score
                FROM q JOIN tf USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id, place)
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER)
                AS rank, doc_id, score
            FROM s WHERE score > 0 QUALIFY rank <= 20""",
    }
