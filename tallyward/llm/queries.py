"""The operators' queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import (
    clustering,
    decontaminate,
    embeddings,
    language,
    licenses,
    minhash,
    packing,
    pii,
    prefix_trie,
    secrets,
    suffixes,
    token_counts,
    toxicity,
)
from tallyward.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The vocabulary of the packing and counting queries; a parameter of the operators.
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def register(name: str, sql: str | None = None):
    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


@register("op5_packing")
def op5_packing(spark, sf_dir):
    """Pieces of whole documents packed into sequences of 4,096 ids."""
    return packing.pack(read_table(spark, sf_dir, "documents"), WORD_VOCABULARY, 4096, 2, keep_ids=False)


@register("op9_suffix_dedup")
def op9_suffix_dedup(spark, sf_dir):
    """What each document loses to strings of 200 bytes that are also elsewhere."""
    docs = read_table(spark, sf_dir, "documents")
    found = suffixes.repeats(docs, 200).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        "doc_id",
        *suffixes.text_key("text"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.sha2(body, 256).alias("whole_sha256"),
    )
    zero = F.lit(0).cast("long")
    return rows.join(found, ["k1", "k2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


@register("op7_dart_minhash")
def op7_dart_minhash(spark, sf_dir):
    """The near-duplicate group of each document."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


_WORDS = """list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w : w <> '')"""


@register(
    "op1_decontamination",
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    wins AS (SELECT DISTINCT item_id, w[i:i + 9] AS win FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS t(i)
        WHERE len(w) > 0),
    sizes AS (SELECT DISTINCT len(win) AS n FROM wins),
    runs AS (SELECT doc_id, i, n, w[i:i + n - 1] AS run
        FROM d, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) AS t(i)),
    hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM runs JOIN wins ON run = win),
    per_word AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(j) GROUP BY 1),
    per_item AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::varchar, ','
        ORDER BY item_id::varchar) AS ids FROM hits GROUP BY 1)
    SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN per_word USING (doc_id) LEFT JOIN per_item USING (doc_id)""",
)
def op1_decontamination(spark, sf_dir):
    """Which words of each document lie in benchmark items."""
    documents, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.digests(decontaminate.contamination(documents, benchmark))


@register("op3_pii")
def op3_pii(spark, sf_dir):
    """Personal data in each document."""
    return pii.digests(pii.personal_spans(read_table(spark, sf_dir, "documents")))


@register("op8_secrets")
def op8_secrets(spark, sf_dir):
    """Secrets in each document."""
    return secrets.digests(secrets.secret_spans(read_table(spark, sf_dir, "documents")))


@register("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    """The toxicity score of each document."""
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    predicted = (F.col("score") >= 0.3).cast("int")
    return toxicity.toxicity(documents, labels).select("doc_id", "held_out", "score", predicted.alias("predicted"), "flagged")


@register("op4_licenses", licenses.oracle_sql())
def op4_licenses(spark, sf_dir):
    """Licences named or quoted in each document."""
    found = licenses.licenses(read_table(spark, sf_dir, "documents"))
    return found.withColumn("licenses", F.array_join("licenses", ","))


@register("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    """Tokens of each line of each document, encoded as a whole."""
    documents = read_table(spark, sf_dir, "documents")
    return token_counts.section_tokens(documents, BYTE_VOCABULARY, public_tokenizers.PATTERN)


@register("op10_embedding_dedup")
def op10_embedding_dedup(spark, sf_dir):
    """Links and components of the embeddings."""
    return embeddings.near_vectors(read_table(spark, sf_dir, "embeddings"))


_CRC32 = """xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''),
    lambda ch : ascii(ch)::bigint)), lambda crc, ch : list_reduce(list_concat([xor(crc, ch)], list_value(0, 0, 0, 0, 0, 0, 0, 0)::bigint[]),
    lambda x, k : xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


@register(
    "op11_prefix_trie",
    f"""WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i FROM conversations WHERE conv_id IS NOT NULL),
    sizes AS (SELECT conv_id, count(*) AS n FROM t GROUP BY 1),
    heads AS (SELECT s.conv_id, s.conv_id - s.conv_id % 20 AS lender, h, least(h, coalesce(l.n, 0)) AS lent
        FROM (SELECT conv_id, n, {_CRC32} % 4 AS h FROM sizes) s LEFT JOIN sizes l ON l.conv_id = s.conv_id - s.conv_id % 20),
    rebuilt AS (SELECT heads.conv_id, i AS p, role, text FROM heads JOIN t ON t.conv_id = lender AND i <= h
        UNION ALL SELECT conv_id, i - h + lent, role, text FROM t JOIN heads USING (conv_id) WHERE i > h),
    paths AS (SELECT conv_id, coalesce(list({{'r': role, 't': text}} ORDER BY p) FILTER (p IS NOT NULL), []) AS s
        FROM heads LEFT JOIN rebuilt USING (conv_id) GROUP BY 1),
    prefixes AS (SELECT conv_id, d, len(s) AS n, s[1:d] AS k,
        len(list_filter(regexp_split_to_array(coalesce(s[d].t, ''), '[\x20\x09-\x0D]+'), lambda w : w <> '')) AS words
        FROM paths, unnest(range(0, len(s) + 1)) AS u(d)),
    nodes AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words, max(n) = d AS leaf,
        string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (n = d) AS ends FROM prefixes GROUP BY 1, 2),
    above AS (SELECT k[1:a] AS k, a AS d, count(*) FILTER (nodes.d = a + 1) AS n_children, count(*) FILTER (leaf) AS n_leaves,
        sum((n_convs - 1) * words) AS saved FROM nodes, unnest(range(0, nodes.d + 1)) AS u(a) GROUP BY 1, 2)
    SELECT nodes.conv_id, nodes.d::bigint AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, n_children, n_leaves,
        saved::bigint AS saved_tokens, sha256(coalesce(nodes.ends, '')) AS ends_sha256
    FROM nodes JOIN above ON above.d = nodes.d AND above.k = nodes.k
    LEFT JOIN nodes up ON up.d = nodes.d - 1 AND up.k = nodes.k[1:nodes.d - 1]""",
)
def op11_prefix_trie(spark, sf_dir):
    """The trie of conversations that take their first turns from the first of each twenty."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"), 20, head, 3)


def _clustering_sql(k: int = 8, rounds: int = 10) -> str:
    steps = [
        """WITH points AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x : floor(1024 * x::double)::bigint) AS v
        FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x : x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS MATERIALIZED (SELECT n, v FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS n, v
        FROM points) WHERE n < {k})""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT vec_id, any_value(p.v) AS v, min(list_sum(list_transform(list_zip(p.v, c.v),
            lambda z : (z[1] - z[2]) * (z[1] - z[2]))) * {k} + n) AS best FROM points p, c{i} c GROUP BY vec_id)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT c.n, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN
                (SELECT n, list(((s - (s % q + q) % q) // q)::bigint ORDER BY i) AS v FROM (SELECT best % {k} AS n, i, sum(v[i]) AS s,
                count(*) AS q FROM a{i}, unnest(range(1, 65)) AS u(i) GROUP BY 1, 2) GROUP BY 1) m USING (n))"""
            )
    steps.append(f"found AS (SELECT vec_id, (best % {k})::int AS cluster, (best // {k})::bigint AS distance FROM a{rounds})")
    return (
        ", ".join(steps)
        + f""" SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::bigint AS cluster_inertia,
    (sum(distance) OVER ())::bigint AS inertia, sha256(array_to_string(v, ',')) AS centroid_sha256
    FROM found JOIN c{rounds} ON n = cluster"""
    )


@register("op12_centroid_clusters", _clustering_sql())
def op12_centroid_clusters(spark, sf_dir):
    """The cluster of each embedding of 64 components after ten rounds from eight drawn centroids."""
    return clustering.digests(clustering.centroid_clusters(read_table(spark, sf_dir, "embeddings")))


@register("op13_languages")
def op13_languages(spark, sf_dir):
    """The language of each document."""
    return language.languages(read_table(spark, sf_dir, "documents"))
