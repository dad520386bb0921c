"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitplane, cap_filters, compression, icws, langid, line_dedup, mixing, notices, pii, prefix_trie, rank_index, sentencepiece_codec, superkmer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, parity with the sentencepiece library on each, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), verify_every=1).select("doc_id", "n_tokens", "ids", "parity", "round_trip")


@query
def op2_cap_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.link_vectors(table(spark, sf_dir, "embeddings"))


ORACLE["op2_cap_neardup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  coalesce(vec_id = least(vec_id, coalesce(low, vec_id)), true) AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), short=True)
    return found.select("doc_id", "n_lines", "n_removed", "n_near", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op4_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(md5(text), ''))), 1, 15))::BIGINT AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - 2.0::DOUBLE * coalesce(sum(source_size) OVER b, 0)::DOUBLE)
      / (sum(w) OVER () - coalesce(sum(w) OVER b, 0.0::DOUBLE)) AS level
  FROM w WINDOW b AS (ORDER BY source_size / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(level, (source_size / w, rank)) AS final FROM l WHERE level * w <= 2.0::DOUBLE * source_size),
t AS (SELECT source, source_size, least(coalesce(final * w, 'inf'::DOUBLE), 2.0::DOUBLE * source_size) AS target FROM l, f),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target + 0.5)::BIGINT / source_size)::BIGINT ELSE 0 END AS whole FROM t),
p AS (
  SELECT d.*, source_size, target, whole, floor(target + 0.5)::BIGINT - whole * source_size AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(size) OVER (PARTITION BY d.source, place) AS own
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN upto <= budget OR (upto - own <= budget AND upto - own + upto <= 2 * budget) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn_profiles(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = superkmer.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op6_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
k AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM s),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM k),
h AS (SELECT doc_id, unnest(range(i, i + 50)) AS i FROM f WHERE first < doc_id),
r AS (SELECT doc_id, list(DISTINCT i) AS gone FROM h GROUP BY doc_id),
o AS (SELECT d.doc_id, len(w) AS n, coalesce(len(gone), 0) AS g, list_transform(list_filter(range(1, len(w) + 1), lambda i: gone IS NULL OR NOT list_contains(gone, i)), lambda i: w[i]) AS kept FROM d LEFT JOIN r USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, g::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM o
"""


@query
def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bitplane.ids_digest(bitplane.encode_to_files(docs, public_tokenizers.path("word_bpe_49k.json"), as_bytes=True))


@query
def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = icws.near_duplicates(docs)
    return found.select(F.col("doc").alias("doc_id"), "class_id", F.coalesce(F.col("doc") == F.col("class_id"), F.lit(True)).alias("kept"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return compression.quality_rules(docs).select("doc_id", "quality.*")


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.span_text(True), 256).alias("base_sha256"), pii.span_text(False).alias("spans"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.encode_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(turns))


ORACLE["op11_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id AS c, turn, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS w
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({'k': k, 'w': w} ORDER BY turn NULLS FIRST, k) AS s FROM t GROUP BY c),
h AS (
  SELECT c, s, (4294967295 - list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 4 AS h
  FROM o),
r AS (SELECT a.c, list_concat(coalesce(b.s, [])[1:a.h], a.s[a.h + 1:]) AS s FROM h a LEFT JOIN o b ON b.c = a.c - a.c % 20),
p AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM r),
q AS (
  SELECT c, d, d = len(s) AS stops, CASE WHEN d > 0 THEN s[d].w ELSE 0 END AS w,
    list_transform(range(0, d + 1), lambda e: sha256(array_to_string(list_transform(s[1:e], lambda x: x.k), ','))) AS path
  FROM p),
n AS (
  SELECT path[-1] AS k, path[-2] AS up, any_value(path) AS path, d, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (stops) AS ends
  FROM q GROUP BY path[-1], path[-2], d),
m AS (SELECT up, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
x AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN m ON m.up = n.k),
b AS (SELECT unnest(path) AS k, n_children, (n_convs - 1) * w AS saved FROM x),
a AS (SELECT k, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM b GROUP BY k)
SELECT x.conv_id, x.d::BIGINT AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
FROM x JOIN a USING (k) LEFT JOIN n y ON y.k = x.up
"""


@query
def op12_fim_rank_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = rank_index.restored(rank_index.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLE["op12_fim_rank_index"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('42:', doc_id::VARCHAR)) AS h FROM documents),
k AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
    [('0x' || h[8 * i + 1:8 * i + 8])::BIGINT for i in [0, 1, 2, 3]] AS r FROM d),
c AS (
  SELECT doc_id, t, w, len(w)::BIGINT AS n, least(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) AS a, greatest(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 50 THEN 'plain' WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM k),
p AS (SELECT *, coalesce(array_to_string(w[1:a], ''), '') AS prefix, coalesce(array_to_string(w[a + 1:b], ''), '') AS middle, coalesce(array_to_string(w[b + 1:], ''), '') AS suffix FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle) ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END AS output FROM p),
m AS (SELECT *, strpos(output, '<P>') AS xp, strpos(output, '<S>') AS xs, strpos(output, '<M>') AS xm FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN concat(output[4:xs - 1], output[xm + 3:], output[xs + 3:xm - 1])
    ELSE concat(output[xp + 3:xm - 1], output[xm + 3:], output[4:xp - 1]) END) AS restored_sha256
FROM m
"""


@query
def op13_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = notices.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
