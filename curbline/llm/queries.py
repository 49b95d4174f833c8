"""The numbered queries: each applies its operator to its whole table and derives the columns asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import langid, mixing, order_minhash, packing, prefix_trie, pu_quality, sharding, simhash, token_alignment, token_store, toxicity, vector_tiles, vptree
from .runtime import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_vantage_point_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("bigint").alias("taken"), "rate", "copies")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.documents_fingerprints(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.written_and_read(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op13_vector_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_tiles.near_copies(table(spark, sf_dir, "embeddings"))


QUERIES = {q.__name__: q for q in (op1_toxicity, op2_vantage_point_trees, op3_entropy_balancing, op4_simhash, op5_best_fit_packing, op6_byte_gru, op7_order_minhash, op8_quality, op9_byte_shards, op10_token_files, op11_prefix_trie, op12_token_alignment, op13_vector_tiles)}

ORACLES: dict[str, str] = {
    # CRC-32 of the decimal id bit by bit; a sequence is the list of its turns' digests; leaves and weights are summed over all prefixes.
    "op11_prefix_trie": """
        WITH turns AS (
            SELECT conv_id, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, strlen(coalesce(text, '')) AS size,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (
            SELECT conv_id, list({'digest': digest, 'size': size} ORDER BY pos) AS seq,
                   xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                       lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                           lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295) % 9 AS h
            FROM turns GROUP BY conv_id),
        rebuilt AS (
            SELECT o.conv_id, list_concat(coalesce(b.seq, [])[1:o.h], o.seq[o.h + 1:]) AS seq
            FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
        prefixes AS (
            SELECT conv_id AS member, d, array_to_string(list_transform(seq[1:d], lambda t: t.digest), '') AS path,
                   array_to_string(list_transform(seq[1:d - 1], lambda t: t.digest), '') AS above, len(seq) AS own_length,
                   CASE WHEN d > 0 THEN seq[d].size ELSE 0 END AS size
            FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM rebuilt)),
        nodes AS (
            SELECT path, any_value(above) AS above, any_value(d) AS depth, min(member) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                   sha256(coalesce(string_agg(member::VARCHAR, ',' ORDER BY member) FILTER (d = own_length), '')) AS ends_sha256
            FROM prefixes GROUP BY path),
        children AS (SELECT above AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above),
        own_sums AS (
            SELECT n.*, coalesce(c.n, 0) AS n_children, (n.n_convs - 1) * n.size AS saved FROM nodes n LEFT JOIN children c USING (path)),
        sums AS (
            SELECT p.path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
            FROM own_sums o JOIN prefixes p ON p.member = o.conv_id AND p.d <= o.depth GROUP BY p.path)
        SELECT o.conv_id, o.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves,
               s.saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
        FROM own_sums o JOIN sums s USING (path) LEFT JOIN nodes a ON o.depth > 0 AND a.path = o.above""",
    # Every pair of a label in double precision, then what is reachable from each vector.
    "op13_vector_tiles": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v, row_number() OVER () AS r FROM embeddings),
        usable AS (
            SELECT * FROM vectors WHERE label IS NOT NULL AND len(v) > 0 AND list_bool_and(list_transform(v, lambda x: x IS NOT NULL AND isfinite(x)))
                AND list_bool_or(list_transform(v, lambda x: x <> 0))),
        links AS (
            SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
            WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
        reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
        least AS (SELECT a, min(v.vec_id) AS vec_id FROM reached JOIN vectors v ON v.r = b GROUP BY a),
        degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT v.vec_id, coalesce(n, 0) AS n_links, least(v.vec_id, l.vec_id) AS component_id, coalesce(v.vec_id <= coalesce(l.vec_id, v.vec_id), false) AS kept
        FROM vectors v LEFT JOIN least l ON l.a = v.r LEFT JOIN degrees d ON d.a = v.r""",
}
