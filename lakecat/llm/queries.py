"""The operators of this package over the test tables, one query each, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakecat.llm import fingerprints, jaccard, licences, mixing, neighbours, pieces, repeats, resampling, sharding, simplex, token_files, toxicity, warc
from lakecat.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]
#: The folder of tokenizer files is a parameter of the operators; these queries use the installed one.
TOKENIZER, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.search(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, folder, "documents"), 16)


def op3_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"), words=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"), repeats=True).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")


def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as files: a directory per source, thousand and fifty. A text that speaks of a licence is a licence file
    of its source, thousand or fifty, by its doc_id, so that most files inherit, from any of three depths."""
    number = F.col("doc_id").cast("string")
    speaks = F.coalesce(F.col("text").rlike("(?i)licen[cs]e"), F.lit(False))
    parts = F.array(F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 1000).cast("string"),
                    F.floor(F.col("doc_id") / 50).cast("string"))
    depth = F.when(speaks, F.coalesce(F.col("doc_id") % 3 + 1, F.lit(1)).cast("int")).otherwise(F.lit(3))
    name = F.concat(F.when(speaks, F.lit("LICENSE-")).otherwise(F.lit("")), F.coalesce(number, F.lit("none")), F.lit(".txt"))
    path = F.concat(F.array_join(F.slice(parts, F.lit(1), depth), "/"), F.lit("/"), name)
    return licences.scan(table(spark, folder, "documents").select(path.alias("path"), "text"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(docs, table(spark, folder, "labels"))
    return scored.select(
        "doc_id", toxicity.in_held_out().alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.3).cast("int").alias("predicted"))


def op7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's encoding in digest, and whether decoding gives its text again."""
    model = tokenizer_file(PIECES)
    encoded = pieces.encode(table(spark, folder, "documents"), model).select(
        "doc_id", "ids", "cost", F.xxhash64(F.translate("text", pieces.SPACE, " ")).alias("text_hash"))
    return pieces.decode(encoded, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "cost", F.xxhash64("ids").alias("ids_hash"),
        (F.xxhash64("decoded") == F.col("text_hash")).alias("round_trip"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    taken = F.col("mix_size") * F.col("mix_whole") + F.col("mix_part")
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), taken.alias("taken"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    read = token_files.round_trip(table(spark, folder, "documents"), tokenizer_file(TOKENIZER))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return simplex.cluster(table(spark, folder, "embeddings"))


def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Null keys and rows that repeat a key have the order that `remove_repeats` states."""
    return repeats.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def shipped(query: Query) -> Query:
    """The query, once the executors have this package."""
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


#: Column expressions and joins only: their executors run no Python.
NATIVE = (op2_sharding, op4_fingerprints, op5_licences, op8_mixing)
OTHERS = (op1_neighbours, op3_jaccard, op6_toxicity, op7_pieces, op9_warc, op10_token_files, op11_clusters, op12_resampling, op13_repeats)
QUERIES: dict[str, Query] = {f.__name__: f for f in NATIVE} | {f.__name__: shipped(f) for f in OTHERS}

def clusters_sql(rounds: int = 3) -> str:
    """One assignment a round, and the centroids that follow from it."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        apart{i} AS (
            SELECT v.row, c.cluster, SUM((v.x - c.x) * (v.x - c.x)) AS distance
            FROM parts v JOIN centres{i} c ON v.component = c.component GROUP BY ALL),
        near{i} AS (
            SELECT row, MIN(cluster) AS cluster, MIN(distance) AS distance FROM (
                SELECT *, MIN(distance) OVER (PARTITION BY row) AS least FROM apart{i}) WHERE distance = least GROUP BY row)""")
        if i < rounds:
            steps.append(f"""
        centres{i + 1} AS (
            SELECT c.cluster, c.component, COALESCE(m.x, c.x) AS x FROM centres{i} c LEFT JOIN (
                SELECT n.cluster, v.component,
                    (SUM(v.x) - ((SUM(v.x) % COUNT(*)) + COUNT(*)) % COUNT(*)) // COUNT(*) AS x
                FROM near{i} n JOIN parts v ON n.row = v.row GROUP BY ALL) m
            ON c.cluster = m.cluster AND c.component = m.component)""")
    return f"""
        WITH whole AS MATERIALIZED (
            SELECT ROW_NUMBER() OVER () AS row, vec_id, embedding FROM embeddings
            WHERE len(embedding) = 64 AND list_count(embedding) = 64
                AND isfinite(list_max(embedding)) AND isfinite(list_min(embedding))),
        parts AS MATERIALIZED (
            SELECT row, component, CAST(FLOOR(64 * CAST(embedding[component] AS DOUBLE)) AS HUGEINT) AS x
            FROM whole, (SELECT UNNEST(range(1, 65)) AS component)),
        first AS (
            SELECT row, ROW_NUMBER() OVER (ORDER BY sha256('1:' || COALESCE(CAST(vec_id AS VARCHAR), ''))) - 1 AS cluster
            FROM whole ORDER BY 2 LIMIT 16),
        centres0 AS (SELECT cluster, component, x FROM first JOIN parts ON first.row = parts.row),{",".join(steps)},
        names AS (
            SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY component)) AS centroid_sha256
            FROM centres{rounds} GROUP BY cluster)
        SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
            CAST(SUM(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
            CAST(SUM(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM near{rounds} JOIN whole USING (row) JOIN names USING (cluster)"""


ORACLES: dict[str, str] = {
    "op3_jaccard": r"""
        WITH RECURSIVE numbered AS MATERIALIZED (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(
                text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        places AS (SELECT row, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM numbered WHERE len(words) > 0),
        items AS MATERIALIZED (
            SELECT DISTINCT row, CASE WHEN len(words) < 3 THEN array_to_string(words, ' ')
                ELSE words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] END AS shingle FROM places),
        sizes AS (SELECT row, count(*) AS n FROM items GROUP BY row),
        shared AS (
            SELECT a.row AS x, b.row AS y, count(*) AS common FROM items a JOIN items b ON a.shingle = b.shingle AND a.row <> b.row
            GROUP BY ALL),
        links AS MATERIALIZED (
            SELECT x, y FROM shared JOIN sizes a ON x = a.row JOIN sizes b ON y = b.row WHERE 100 * common >= 90 * (a.n + b.n - common)),
        reached AS (
            SELECT row, row AS other FROM numbered
            UNION SELECT reached.row, links.y FROM reached JOIN links ON reached.other = links.x)
        SELECT d.doc_id, COALESCE(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
        FROM reached JOIN numbered d ON reached.row = d.row JOIN numbered o ON reached.other = o.row
        LEFT JOIN sizes ON sizes.row = d.row GROUP BY d.row, d.doc_id""",
    "op11_clusters": clusters_sql(),
    "op8_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
        sources AS (
            SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
                [3, 1, 2][(ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sized GROUP BY source),
        ranked AS (
            SELECT *, 1.5::DOUBLE * SUM(source_size) OVER () AS wanted,
                COALESCE(SUM(source_size * 2.0::DOUBLE) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS clamped,
                SUM(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
            FROM sources WINDOW o AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST)),
        level AS (
            SELECT (wanted - clamped) / free AS level FROM ranked
            WHERE weight * ((wanted - clamped) / free) <= source_size * 2.0::DOUBLE
            ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST LIMIT 1),
        targets AS (
            SELECT source, source_size, LEAST(source_size * 2.0::DOUBLE, weight * level) AS target FROM sources, level),
        drawn AS (
            SELECT doc_id, size, source_size, target,
                CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS epochs,
                CAST('0x' || substr(md5('8|' || COALESCE(CAST(doc_id AS VARCHAR), chr(0))), 1, 8) AS BIGINT)
                    / 4294967296.0::DOUBLE AS unit
            FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
        SELECT doc_id, size, source_size, target,
            CAST(size * FLOOR(epochs) + FLOOR(size * (epochs - FLOOR(epochs)) + unit) AS BIGINT) AS taken FROM drawn""",
    "op9_warc": """
        WITH headers AS (
            SELECT page_id, CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes,
                sha256(COALESCE(html, '')) AS payload_digest FROM pages),
        roles AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN MIN(page_id) OVER (PARTITION BY payload_digest) END AS first_id
            FROM headers)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id > first_id THEN first_id END AS refers_to FROM roles""",
}
