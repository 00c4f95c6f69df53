"""The operators over the driver's tables, and their SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe,
    exact_dedup,
    hard_negatives,
    lattice_dedup,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    permutation_index,
    quality,
    sharding,
    toxicity,
    whitening,
)
from tidemark.llm.common import text_of


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = license_scan.scan(docs, license_scan.fit(docs))
    return found.select("doc_id", "paragraph", "family", "template", "confirmed", "likeness", "probability")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    # Only what the result shows takes part in the exchange.
    narrow = docs.select("doc_id", "text", F.crc32(text_of("text")).alias("text_crc32"))
    found = sharding.shard(narrow, carry=["doc_id", "text_crc32"])
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    narrow = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(packing.stored(narrow, "pieces")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return ngram_join.near_duplicates(docs, words=4, percent=85).select("doc_id", "n_shingles", "component_id")


def _remainder(id: str, n: int) -> Column:
    return F.crc32(F.col(id).cast("string")) % n


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False))
    model = toxicity.fit(docs, labels.where(~held_out), label="toxic")
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return permutation_index.nearest_neighbours(vectors, lambda id: id % 20 == 0)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.drop_repeated_lines(docs)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False))
    model = quality.fit(docs, labels.where(~held_out), label="quality")
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label), lambda id: id % 100 == 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_license_scan": op3_license_scan,
    "op4_sharding": op4_sharding,
    "op5_packing": op5_packing,
    "op6_ngram_join": op6_ngram_join,
    "op7_toxicity": op7_toxicity,
    "op8_permutation_index": op8_permutation_index,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_lattice_dedup": op13_lattice_dedup,
}

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

ORACLES = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256({_NORMAL}) AS sha FROM documents),
        r AS (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY chars DESC, doc_id) AS place,
                     first_value(doc_id) OVER (PARTITION BY sha ORDER BY chars DESC, doc_id) AS keep_id,
                     count(*) OVER (PARTITION BY sha) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha AS text_sha256 FROM r
    """,
    "op6_ngram_join": r"""
        WITH RECURSIVE
        w AS (SELECT doc_id, list_filter(regexp_split_to_array(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
        g AS (SELECT doc_id, CASE
                  WHEN len(words) = 0 THEN []
                  WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                  ELSE list_distinct(list_transform(range(1, len(words) - 2),
                       lambda i: array_to_string(words[i:i + 3], ' '))) END AS grams FROM w),
        n AS (SELECT doc_id, len(grams) AS n FROM g),
        t AS (SELECT doc_id, unnest(grams) AS gram FROM g),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
              FROM t a JOIN t b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
              WHERE 100 * common >= 85 * (na.n + nb.n - common)),
        e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        reach AS (SELECT doc_id AS node, doc_id AS other FROM documents
                  UNION SELECT reach.node, e.b FROM reach JOIN e ON reach.other = e.a)
        SELECT n.doc_id, n.n AS n_shingles, min(reach.other) AS component_id
        FROM n JOIN reach ON reach.node = n.doc_id GROUP BY 1, 2
    """,
    "op9_line_dedup": r"""
        WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM s),
        k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
        m AS (SELECT k.*, coalesce(f.first < k.doc_id, false) AS dropped FROM k LEFT JOIN f USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
              FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                CAST(list_dot_product(CAST(a.x AS DOUBLE[]), CAST(r.x AS DOUBLE[])) AS BIGINT) AS score
              FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (
                PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
              FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
                AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
    """,
    "op13_lattice_dedup": """
        WITH RECURSIVE
        v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
                AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
        e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
              WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
        reach AS (SELECT vec_id AS node, vec_id AS other FROM embeddings
                  UNION SELECT reach.node, e.b FROM reach JOIN e ON reach.other = e.a),
        n AS (SELECT a AS vec_id, count(*) AS n FROM e GROUP BY 1),
        c AS (SELECT node AS vec_id, min(other) AS component_id FROM reach GROUP BY 1)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
    """,
}
