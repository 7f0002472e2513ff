"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.jaccard_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), size=4, num=85, den=100)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.packing import encode_pieces, pack_pieces

    pieces = encode_pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 2048)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack_pieces(digests, 2048).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tessarea.llm.bpe_transducer import encode_texts

    both = encode_texts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decode=True)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.weak_quality import fit, score

    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.anisotropic_search import build, search

    index, words = build(table(spark, sf_dir, "embeddings"))
    return search(index, words, F.col("vec_id") % 50 == 0)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.quality_rules import measure

    judged = measure(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        F.col("__rule_words").alias("n_words"),
        F.col("__rule_word_chars").alias("word_chars"),
        F.col("__rule_symbols").alias("n_symbols"),
        F.col("__rule_dup_lines").alias("n_dup_lines"),
        F.col("__rule_repeats").alias("n_repeat_words"),
        F.col("__rule_base_failed").alias("base_failed"),
        F.col("__rule_kept").alias("kept"),
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.token_files import token_file_round_trip

    back = token_file_round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.secret_scan import BASE_KINDS, fit_on_documents, scan

    docs = table(spark, sf_dir, "documents")
    found = scan(docs, fit_on_documents(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))
    kinds = F.transform("spans", lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.language_id import fit, identify

    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.sharding import assign_shards

    placed = assign_shards(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.prefix_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.simhash_join import near_fingerprints

    return near_fingerprints(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessarea.llm.source_divergence import divergence

    return divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(t, '[ \t-\r]+'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, sum(least(3, coalesce(nxt - i, 3))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM dup) GROUP BY r),
ln AS (SELECT r, x, regexp_replace(x, '[ \t-\r]', '', 'g') AS bare FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d)),
lines AS (SELECT r, x, bare, length(bare) AS n,
    length(regexp_replace(x, '[^!?]', '', 'g')) * 20 > length(bare)
    OR length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) * 20 > length(bare)
    OR (length(regexp_replace(bare, '[^\pL]', '', 'g')) >= 20 AND length(regexp_replace(bare, '[^\p{Lu}]', '', 'g')) * 2 > length(regexp_replace(bare, '[^\pL]', '', 'g')))
    OR length(regexp_replace(x, '[^|>»›•]', '', 'g')) * 12 > length(bare)
    OR regexp_matches(lower(x), 'PHRASES') AS failed
  FROM ln WHERE bare <> ''),
lost AS (SELECT r, sum(CASE WHEN failed THEN n ELSE 0 END) AS lost, count(*) - count(DISTINCT x) AS dup_lines FROM lines GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[ \t-\r]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= 0.5 * word_chars AS kept
FROM m
"""


OP11_SQL = r"""
WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT conv_id, xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS UBIGINT))),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda u, v: xor(u >> 1, (u & 1) * 3988292384::UBIGINT)))) % 4 AS h
  FROM ids),
t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(length(role) || ':' || role || text), 1, 32)) AS r
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
rebuilt AS (
  SELECT h.conv_id, 0 AS part, r, role, text FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 20 AND r <= h
  UNION ALL SELECT conv_id, 1, r, role, text FROM h JOIN t USING (conv_id) WHERE r > h),
s AS (SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, r) FILTER (WHERE r IS NOT NULL), []) AS turns FROM h LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
pre AS (SELECT conv_id, d, turns[1:d] AS p, d = len(turns) AS ended FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM s)),
nodes AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends FROM pre GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS children FROM nodes WHERE d > 0 GROUP BY 1, 2),
own AS (SELECT nodes.*, coalesce(children, 0) AS children, CASE WHEN d > 0 THEN (n - 1) * len(regexp_extract_all(p[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved FROM nodes LEFT JOIN kids USING (p, d)),
sub AS (SELECT p[1:k] AS p, k AS d, sum(saved) AS saved_tokens, count(*) FILTER (WHERE children = 0) AS leaves FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM own) GROUP BY 1, 2)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(o.n AS BIGINT) AS n_convs, CAST(o.children AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, o.ends AS ends_sha256
FROM own o JOIN sub USING (p, d) LEFT JOIN nodes up ON up.d = o.d - 1 AND up.p = o.p[1:o.d - 1]
"""

OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n_lang FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
size AS (SELECT lang, count(*) AS v, sum(n_lang) AS all_n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
total AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
dense AS (SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (coalesce(total, 0) + 2 * v) AS p, 1 + (1000000000::HUGEINT * (n_lang + 2)) // (all_n + 2 * v) AS q
  FROM g JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN total USING (lang, source)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM dense WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found) WHERE part = 'pair' OR rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    from tessarea.llm.quality_rules import BOILERPLATE

    return {"op6_quality_rules": OP6_SQL.replace("PHRASES", "|".join(BOILERPLATE)), "op11_prefix_trie": OP11_SQL, "op13_source_divergence": OP13_SQL}
