"""The registered queries of this package: thin digests of its operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from histkit.llm import language_model
from histkit.llm.common import documents, whole_texts
from histkit.llm.decontamination import find_leaks
from histkit.llm.fingerprints import as_text, fingerprint, likeness
from histkit.llm.hard_negatives import hard_negatives
from histkit.llm.near_duplicates import near_duplicate_classes
from histkit.llm.ordered import with_next
from histkit.llm.pieces import encode_pieces
from histkit.llm.prefix_trie import prefix_nodes
from histkit.llm.secrets import KINDS, find_secrets, spans_text
from histkit.llm.sharding import shard_by_bytes
from histkit.llm.substrings import remove_repeats
from histkit.llm.token_files import read_token_files, write_token_files
from histkit.llm.toxicity import THRESHOLD, fit, held_out, score
from histkit.llm.vector_duplicates import vector_links
from histkit.llm.vectors import embeddings


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text, and the text with its second half replaced from the next document."""
    texts = whole_texts(documents(spark, sf_dir))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    both = (
        with_next(texts, "doc_id", "text", ["text", "print"], derive={"print": fingerprint(F.col("text"))})
        .select("doc_id", n.cast("bigint").alias("n_chars"), "print", "next_print", edited.alias("edited"))
        .withColumn("edited_print", fingerprint(F.col("edited")))
    )
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] != KINDS.index("opaque"))

    def count(test):
        return F.size(F.filter("spans", test)).cast("bigint")

    def of_kind(k):
        return lambda s: s["kind"] == k

    return found.select(
        "doc_id",
        *[count(of_kind(k)).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        count(lambda s: s["verdict"] == "live").alias("n_live"),
        count(lambda s: s["verdict"] == "example").alias("n_example"),
    )


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    unseen = held_out(F.col("doc_id"), 5)
    model, counts = language_model.fit(docs.where(~unseen))
    return language_model.score(docs, unseen, model, counts)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels, ~held_out(F.col("doc_id"), 3))
    return score(docs.select("doc_id", "text"), model).select("row.doc_id", "score").select(
        "doc_id",
        held_out(F.col("doc_id"), 3).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), hashed=True).withColumnRenamed("kept", "kept_sha256")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "first")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings(spark, sf_dir), moved)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_nodes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(embeddings(spark, sf_dir))


QUERIES = {
    q.__name__: q
    for q in (
        op1_fingerprints,
        op2_token_files,
        op3_secrets,
        op4_pieces,
        op5_language_model,
        op6_toxicity,
        op7_substrings,
        op8_decontamination,
        op9_near_duplicates,
        op10_sharding,
        op11_hard_negatives,
        op12_prefix_trie,
        op13_vector_duplicates,
    )
}

#: The same rows as SQL, where SQL can express the method.
SQL: dict[str, str] = {
    "op7_substrings": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d),
        windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM starts),
        first AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN first USING (k) WHERE m < doc_id),
        each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
            FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op11_hard_negatives": """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                   CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
            FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id,
               positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY rank <= 3""",
    "op12_prefix_trie": """
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
            FROM conversations WHERE conv_id IS NOT NULL),
        lengths AS (
            SELECT conv_id, conv_id - conv_id % 5 AS first, CAST(conv_id AS VARCHAR) AS name, max(place) AS n
            FROM turns GROUP BY ALL),
        shared AS (
            SELECT conv_id, first, (4294967295 - list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(1, len(name) + 1), lambda i: ascii(name[i])::BIGINT)),
                lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)),
                    lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) % 9 AS h
            FROM lengths),
        taken AS (
            SELECT s.conv_id, s.first, h, least(h, coalesce(f.n, 0)) AS t
            FROM shared s LEFT JOIN lengths f ON f.conv_id = s.first),
        rebuilt AS (
            SELECT conv_id, place - h + t AS d, role, text FROM turns JOIN taken USING (conv_id) WHERE place > h
            UNION ALL
            SELECT a.conv_id, place, role, text FROM taken a JOIN turns s ON s.conv_id = a.first AND place <= h),
        whole AS (
            SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY d) FILTER (d IS NOT NULL), []) AS w
            FROM lengths LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
        ways AS (
            SELECT conv_id, unnest(range(0, len(w) + 1)) AS depth, w FROM whole),
        keyed AS (
            SELECT conv_id, depth, depth = len(w) AS ends, md5(CAST(w[1:depth] AS VARCHAR)) AS k,
                   CASE WHEN depth > 0 THEN md5(CAST(w[1:depth - 1] AS VARCHAR)) END AS up,
                   CASE WHEN depth > 0 THEN strlen(w[depth].text) ELSE 0 END AS bytes
            FROM ways),
        nodes AS (
            SELECT depth, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM keyed GROUP BY depth, k),
        children AS (SELECT depth - 1 AS depth, up AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
        told AS (
            SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (depth, k)),
        below AS (
            SELECT a.depth, a.k, count(DISTINCT t.k || t.depth) FILTER (t.n_children = 0) AS n_leaves,
                   sum((t.n_convs - 1) * t.bytes) AS saved_tokens
            FROM (SELECT DISTINCT a.depth, a.k, b.depth AS d2, b.k AS k2
                  FROM keyed a JOIN keyed b ON a.conv_id = b.conv_id AND b.depth >= a.depth) a
            JOIN told t ON t.depth = d2 AND t.k = k2 GROUP BY a.depth, a.k)
        SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, b.n_leaves,
               CAST(b.saved_tokens AS BIGINT) AS saved_tokens, t.ends_sha256
        FROM told t JOIN below b USING (depth, k) LEFT JOIN nodes p ON p.depth = t.depth - 1 AND p.k = t.up""",
    "op13_vector_duplicates": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        sized AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM usable),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM sized a JOIN sized b ON a.vec_id <> b.vec_id
            WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.95),
        reach AS (SELECT DISTINCT a AS vec_id, a AS other FROM links UNION SELECT vec_id, b FROM reach JOIN links ON other = a),
        counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
        least AS (SELECT vec_id, min(other) AS component FROM reach GROUP BY vec_id)
        SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
               vec_id = coalesce(component, vec_id) AS kept
        FROM embeddings LEFT JOIN counted USING (vec_id) LEFT JOIN least USING (vec_id)""",
}
