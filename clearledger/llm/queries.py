"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.llm import bpe, embeddings, html, langid, lines, minhash, packing, quality, ranking, secrets, sharding, toxicity, trie
from clearledger.llm.common import id_remainder

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("token_bytes").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack_digest(packing.pack(docs, tokenizer_path(WORD_TOKENIZER), END_ID))


def op2_sign_hash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op3_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_bottom_k_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op5_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "sentences"
    )


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.fuzzy_lines(spark, table(spark, sf_dir, "documents"), least_chars=1)


def op7_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(spark, table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "words_left"
    )


def op8_family_then_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    model = langid.train(docs, ~held_out)
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(spark, table(spark, sf_dir, "documents"), n_shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(spark, table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in secrets.BASE_RULES]))
    return found.select(
        "doc_id",
        *[count(r.kind) for r in secrets.BASE_RULES],
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def op11_bag_deduplicated_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark, trie.rebuilt(spark, table(spark, sf_dir, "conversations")))


def op13_text_to_tag_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sum_of_squares_packing,
        op2_sign_hash_near_duplicates,
        op3_backtracking_bpe,
        op4_bottom_k_near_duplicates,
        op5_noisy_or_toxicity,
        op6_fuzzy_lines,
        op7_line_frequency_rules,
        op8_family_then_language,
        op9_kd_tree_shards,
        op10_blob_ledger_secrets,
        op11_bag_deduplicated_search,
        op12_conversation_prefix_trie,
        op13_text_to_tag_extraction,
    )
}
OP7_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(t, '[ \\t-\\r]+'), lambda x: x <> '') AS ws FROM d),
g AS (
    SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
    FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
inside AS (SELECT r, count(DISTINCT i + k) AS n_repeat FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
raw AS (SELECT r, host, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (
    SELECT r, host, line, len(list_filter(regexp_split_to_array(line, '[ \\t-\\r]+'), lambda x: x <> '')) AS n,
        trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[ \\t-\\r]+', ' ', 'g')) AS norm
    FROM raw WHERE regexp_matches(line, '[^ \\t-\\r]')
),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup FROM lines GROUP BY r),
frequent AS (SELECT host, norm FROM lines GROUP BY ALL HAVING count(DISTINCT r) > 10),
lost AS (SELECT r, sum(n) AS n_lost FROM lines SEMI JOIN frequent USING (host, norm) GROUP BY r),
m AS (
    SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[ \\t-\\r]+', '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words, len(ws) - coalesce(n_lost, 0) AS words_left
    FROM d JOIN w USING (r) LEFT JOIN inside USING (r) LEFT JOIN dup USING (r) LEFT JOIN lost USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * words_left >= n_words AS kept,
    words_left::BIGINT AS words_left
FROM m
"""

def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # which imports this module

    return corpus_pipeline.run(spark, sf_dir)


REGISTRY["pipeline"] = pipeline

OP2_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
l AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
),
r AS (
    SELECT vec_id, vec_id AS c FROM embeddings
    UNION
    SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id WHERE r.c < l.b
),
m AS (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT m.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, m.c AS component_id, m.vec_id = m.c AS kept
FROM m LEFT JOIN n ON n.a = m.vec_id
"""

OP4_SQL = """
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '') AS ws
    FROM documents
),
g AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
l AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id
        JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n, nb.n
    HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))
),
r AS (
    SELECT doc_id, doc_id AS c FROM documents
    UNION
    SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id WHERE r.c < l.b
),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT m.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, m.doc_id = m.c AS kept
FROM m LEFT JOIN n USING (doc_id)
"""

OP11_SQL = """
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), $terms) AS ws
    FROM documents
),
i AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), $terms)) AS term
    FROM benchmark
),
total AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d),
t AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d)
    SEMI JOIN i USING (term) GROUP BY r, term
),
w AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM t GROUP BY term), total
),
m AS (SELECT r, doc_id, 100 - 90 + (90 * len(ws)::BIGINT * n_docs) // n_terms AS m FROM d, total),
s AS (
    SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM t JOIN m USING (r) JOIN w USING (term) JOIN i USING (term) GROUP BY item_id, r
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT item_id, doc_id, score,
        (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank
    FROM s JOIN m USING (r) WHERE score > 0
) WHERE rank <= 10
""".replace("$terms", r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'")

_CRC_STEP = "list_reduce(list_prepend({x}, [0, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
_CRC = (
    "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
    "lambda a, b: " + _CRC_STEP.format(x="xor(a, b)") + "), 4294967295)"
)

OP12_SQL = f"""
WITH o AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
h AS (SELECT conv_id, ts, {_CRC} % 9 AS h FROM o),
c AS (
    SELECT h.conv_id, list_concat(coalesce(b.ts[:h.h], []), h.ts[h.h + 1:]) AS ts
    FROM h LEFT JOIN h b ON b.conv_id = h.conv_id - h.conv_id % 5
),
m AS (SELECT conv_id, len(ts) AS n, unnest(range(0, len(ts) + 1)) AS d, ts FROM c),
k AS (SELECT conv_id, n, d, ts[:d] AS p FROM m),
v AS (
    SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
    FROM k GROUP BY p, d
),
x AS (
    SELECT v.*, u.conv_id AS parent_conv_id, coalesce(w.n, 0) AS n_children
    FROM v LEFT JOIN v u ON u.d = v.d - 1 AND u.p = v.p[:v.d - 1]
    LEFT JOIN (SELECT p[:d - 1] AS p, count(*) AS n FROM v WHERE d > 0 GROUP BY ALL) w ON w.p = v.p
),
up AS (SELECT *, unnest(range(0, d + 1)) AS e FROM x),
s AS (
    SELECT p[:e] AS p, sum((n_children = 0)::BIGINT) AS n_leaves,
        sum(CASE WHEN d > 0 THEN (n_convs - 1) * strlen(p[d].t) ELSE 0 END) AS saved_tokens
    FROM up GROUP BY 1
)
SELECT x.conv_id, d::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
    n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM x JOIN s ON s.p = x.p
"""

ORACLE: dict[str, str] = {"op2_sign_hash_near_duplicates": OP2_SQL, "op4_bottom_k_near_duplicates": OP4_SQL, "op7_line_frequency_rules": OP7_SQL, "op11_bag_deduplicated_search": OP11_SQL, "op12_conversation_prefix_trie": OP12_SQL}
