"""Registered queries of the text operators, with production parameters on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, conversations, fingerprints, language, linededup, mixing, mtree, neardup, packing, pages, secrets, sharding, suffixdedup

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query()
def op9_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(documents(spark, sf_dir), shards=16)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


@query()
def op8_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def raking_sql() -> str:
    """Goals by one sorted pass a marginal, then the sweeps as a recursive query."""
    cues = " ".join(f"WHEN regexp_matches(t, '{cue.replace(chr(39), chr(39) * 2)}') THEN '{name}'" for name, cue in mixing.TOPIC_CUES)
    dims, keep = ("source", "lang", "topic"), mixing.KEEP_SHARE
    parts = [f"""
        docs AS MATERIALIZED (
            SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
                CASE {cues} WHEN length(t) < 200 THEN 'note'
                     WHEN length(t) / (length(t) - length(replace(t, chr(10), '')) + 1) < 60 THEN 'list'
                     ELSE 'prose' END AS topic,
                len(regexp_extract_all(t, '\\S+'))::BIGINT AS tokens
            FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
        cells AS MATERIALIZED (
            SELECT *, coalesce(tokens / nullif(sum(tokens) OVER (), 0), 0) AS cap
            FROM (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL))"""]
    for dim in dims:
        # in order of cap / share, a value is full if what the fuller ones leave would give it more than it has
        parts.append(f"""
        share_{dim} AS (SELECT {dim}, sum(cap) AS cap, pow(sum(tokens), {mixing.TEMPER}) AS p FROM cells GROUP BY {dim} HAVING sum(tokens) > 0),
        level_{dim} AS (
            SELECT *, ({keep} - coalesce(sum(cap) OVER (ORDER BY cap / p, {dim} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(p) OVER (ORDER BY cap / p, {dim} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM share_{dim}),
        goal_{dim} AS MATERIALIZED (
            SELECT {dim}, least(cap, p * (SELECT min_by(level, cap / p) FROM level_{dim} WHERE cap > level * p)) AS goal_{dim} FROM level_{dim})""")
    step = f"SELECT i, source, lang, topic, cap, x, goal_source, goal_lang, goal_topic FROM sweep WHERE i < {mixing.MOST_SWEEPS}"
    for dim in dims:
        step = f"""
            SELECT * REPLACE (CASE WHEN filled AND hold THEN x WHEN hold THEN least(cap, x * (goal_{dim} - held) / free)
                    WHEN held + free > 0 THEN least(cap, x * least(1, goal_{dim} / (held + free))) ELSE 0 END AS x)
            FROM (SELECT *, goal_{dim} >= held AND free > 0 AS hold
                  FROM (SELECT *, sum(CASE WHEN filled THEN x ELSE 0 END) OVER (PARTITION BY {dim}) AS held,
                               sum(CASE WHEN filled THEN 0 ELSE x END) OVER (PARTITION BY {dim}) AS free
                        FROM (SELECT i, source, lang, topic, cap, x, goal_source, goal_lang, goal_topic, x >= cap * (1 - 1e-12) AS filled FROM ({step}))))"""
    return "WITH RECURSIVE" + ",".join(parts) + f""",
        sweep AS (
            SELECT 0 AS i, source, lang, topic, cap, cap * {keep} AS x, coalesce(goal_source, 0) AS goal_source,
                coalesce(goal_lang, 0) AS goal_lang, coalesce(goal_topic, 0) AS goal_topic
            FROM cells LEFT JOIN goal_source USING (source) LEFT JOIN goal_lang USING (lang) LEFT JOIN goal_topic USING (topic)
            UNION ALL
            SELECT i + 1, source, lang, topic, cap, x, goal_source, goal_lang, goal_topic FROM ({step}))
        SELECT doc_id, source, lang, topic, tokens, round(p, 6) AS probability,
            ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / pow(2, 52) < p AS kept
        FROM (SELECT docs.*, CASE WHEN docs.tokens = 0 THEN 1 WHEN cap > 0 THEN x / cap ELSE 0 END AS p
              FROM docs JOIN sweep USING (source, lang, topic) WHERE i = {mixing.MOST_SWEEPS})"""


@query(raking_sql())
def op3_raked_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).withColumn("probability", F.round("probability", 6))


@query()
def op6_random_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    count = lambda k: F.size(F.filter(spans, lambda s: s.kind == k)).cast("long")
    base = F.filter(spans, lambda s: s.kind < secrets.KINDS.index("random"))
    return secrets.find_secrets(documents(spark, sf_dir)).select(
        "doc_id", *[count(k).alias(f"n_{secrets.KINDS[k]}") for k in range(3)],
        F.sha2(secrets.written(base), 256).alias("base_sha256"), secrets.written(spans).alias("spans"),
    )


@query()
def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op2_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(documents(spark, sf_dir))


@query()
def op1_aligned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(documents(spark, sf_dir))
    return found.select("doc_id", "text", F.col("_removed_lines").alias("removed_lines"))


@query()
def op4_probminhash_neardups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


@query()
def op7_consensus_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("""
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, e.vec_id, list_dot_product(q.x, e.x)::BIGINT AS score
        FROM v q JOIN v e ON q.vec_id % 50 = 0 AND q.vec_id <> e.vec_id)
    SELECT * FROM (
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
    WHERE rank <= 5
""")
def op5_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, k=5)


CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


@query(f"""
    WITH turns AS (
        SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS d
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT c, {CRC32_SQL} % {conversations.MOST_SHARED + 1} AS h, c - c % {conversations.BLOCK} AS base FROM (SELECT DISTINCT c FROM turns)),
    parts AS (
        SELECT convs.c, 0 AS part, d, role, text FROM convs JOIN turns ON turns.c = base AND d <= h
        UNION ALL SELECT convs.c, 1, d, role, text FROM convs JOIN turns ON turns.c = convs.c AND d > h),
    rows AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, d) AS depth, role, text FROM parts),
    whole AS (SELECT convs.c, coalesce(list([role, text] ORDER BY depth) FILTER (depth IS NOT NULL), []) AS path
        FROM convs LEFT JOIN rows ON rows.c = convs.c GROUP BY convs.c),
    member AS (SELECT c, len(path) AS length, unnest(range(0, len(path) + 1)) AS depth, path FROM whole),
    node AS (
        SELECT depth, path[1:depth] AS path, min(c) AS conv_id, count(*) AS n_convs,
            sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (length = depth), '')) AS ends_sha256
        FROM member GROUP BY 1, 2),
    sized AS (
        SELECT node.*, up.conv_id AS parent_conv_id, CASE WHEN node.depth = 0 THEN 0 ELSE (node.n_convs - 1) * octet_length(encode(node.path[-1][2])) END AS saved,
            (SELECT count(*) FROM node k WHERE k.depth = node.depth + 1 AND k.path[1:node.depth] = node.path) AS n_children
        FROM node LEFT JOIN node up ON up.depth = node.depth - 1 AND up.path = node.path[1:node.depth - 1]),
    above AS (SELECT unnest(range(0, depth + 1)) AS top, path, saved, n_children FROM sized),
    held AS (
        SELECT top AS depth, path[1:top] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY 1, 2)
    SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
    FROM sized JOIN held USING (depth, path)
""")
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query(f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
            unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
        FROM documents),
    words AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces),
    total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
    grams AS ({" UNION ALL ".join(f"SELECT lang, unnest(list_transform(range(1, len(w) - {k} + 2), lambda i: w[i:i + {k - 1}])) AS g FROM words WHERE len(w) >= {k}" for k in range(1, 5))}),
    f AS MATERIALIZED (SELECT lang, g, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
    cand AS (SELECT * FROM f WHERE len(g) > 1),
    cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM cand),
    scored AS (
        SELECT cuts.*, x.a AS l, y.a AS r, (2000000::HUGEINT * cuts.a // (x.a + y.a))::BIGINT AS score
        FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.g[1:k] JOIN f y ON y.lang = cuts.lang AND y.g = cuts.g[k + 1:]),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    starts AS (SELECT lang, g, a, unnest(range(1, len(g) + 1)) AS i FROM cand),
    inside AS (SELECT lang, g, a, i, unnest(range(i, len(g) + 1)) AS j FROM starts),
    most AS (SELECT lang, g[i:j] AS g, max(a) AS most FROM inside WHERE j - i + 1 < len(g) GROUP BY ALL)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score
    FROM (SELECT best.lang, array_to_string(best.g, ' ') AS phrase, a, l, r, n, score
          FROM best JOIN total USING (lang) LEFT JOIN most ON most.lang = best.lang AND most.g = best.g
          WHERE most IS NULL OR 100 * most < {collocations.SUBSUMED} * a)
    QUALIFY rank <= {collocations.TOP}
""")
def op11_stripe_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


@query()
def op12_induced_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda x, s: x + s.stop - s.start)
    return suffixdedup.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
