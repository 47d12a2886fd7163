"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame`` and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, merkle, minhash, mixing, packing, quality, rabitq, rules, sharding, simhash, tokencount, toxicity, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from a sparse rule ensemble."""
    return quality.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash fingerprints of every document and its edited text."""
    return minhash.fingerprint_documents(_read(spark, sf_dir, "documents"))


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC archives of all pages, written and read back in byte ranges."""
    return warc.archive_round_trip(_read(spark, sf_dir, "pages"), min_bytes=0)


def op4_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected toxicity severity of every document."""
    return toxicity.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest neighbours of every vector whose id is divisible by 50."""
    return rabitq.search(_read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token pieces packed into sequences of 4096."""
    return packing.pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    out = simhash.near_duplicates(_read(spark, sf_dir, "documents"), radius=4, words=4)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document by heap-and-linked-list merging."""
    return tokencount.count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 40 shards of even row counts, equal texts together where they fit."""
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), shards=40)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(_read(spark, sf_dir, "documents"), weights=(5, 2, 1), max_epochs=3)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents and a proof of each, a seventh of them tampered with."""
    return merkle.audit(_read(spark, sf_dir, "documents"), every=7)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language, and each source's most typical terms."""
    return divergence.audit(_read(spark, sf_dir, "documents"), min_documents=30, smoothing=5, scale=1_000_000_000, top=50)


def op13_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict of the threshold table."""
    return rules.judge(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_minhash_fingerprints, op3_warc_round_trip, op4_toxicity_ordinal, op5_rotated_codes,
    op6_best_fit_packing, op7_simhash_covering, op8_token_counts, op9_balanced_shards, op10_source_mix,
    op11_merkle_manifest, op12_source_divergence, op13_rule_table)}

# One row of a payload's digest in base 32: the bits of its SHA-1, five at a time.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST(list_sum(list_transform(range(5), lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS INTEGER), 1) AS INTEGER) * (16 >> j))) AS INTEGER), 1)), '')"""

SQL: dict[str, str] = {
    "op3_warc_round_trip": f"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (
    SELECT page_id, strlen(body) AS payload_bytes, CAST(CAST(unhex(sha1(body)) AS BIT) AS VARCHAR) AS bits FROM payloads),
holders AS (
    SELECT bits AS held, max(page_id) AS holder FROM digests GROUP BY bits)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < holder THEN holder END AS refers_to
FROM digests JOIN holders ON bits = held""",
    "op5_rotated_codes": """
WITH v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (
    SELECT DISTINCT vec_id, e, sqrt(list_inner_product(e, e)) AS size FROM v
    WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) / (q.size * c.size) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5""",
    # A run is a list of digests, and a level is the list of the pairs' digests.  crc32 is folded bit by bit.
    "op11_merkle_manifest": r"""
WITH RECURSIVE rows AS (
    SELECT doc_id, lang, n_chars, CAST(doc_id AS VARCHAR) AS id_text, coalesce(strlen(source) || ':' || source, '-') AS f_source,
           coalesce(strlen(lang) || ':' || lang, '-') AS f_lang, coalesce(strlen(text) || ':' || text, '-') AS f_text
    FROM documents),
sums AS (
    SELECT *, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(id_text, ''),
               lambda c: list_concat([256 + ascii(c)], [0, 0, 0, 0, 0, 0, 0, 0])))),
               lambda a, x: CASE WHEN x > 0 THEN xor(a, x - 256) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) AS crc
    FROM rows),
hashed AS (
    SELECT doc_id, lang, crc % 7 = 0 AS tampered,
           sha256(coalesce(strlen(id_text) || ':' || id_text, '-') || f_source || f_lang
                  || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || f_text) AS leaf,
           sha256(coalesce(strlen(id_text) || ':' || id_text, '-') || f_source || f_lang
                  || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || f_text) AS altered
    FROM sums),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM hashed),
levels AS (
    SELECT tree, 0 AS level, list(leaf ORDER BY place) AS h FROM placed GROUP BY tree
    UNION ALL
    SELECT tree, level + 1, list_transform(range(0, len(h), 2), lambda i: sha256(h[i + 1] || coalesce(h[i + 2], '')))
    FROM levels WHERE len(h) > 1),
subroots AS (
    SELECT tree, h[1] AS subroot FROM levels WHERE len(h) = 1),
top AS (
    SELECT -1 AS tree, 0 AS level, list(subroot ORDER BY tree) AS h FROM subroots
    UNION ALL
    SELECT tree, level + 1, list_transform(range(0, len(h), 2), lambda i: sha256(h[i + 1] || coalesce(h[i + 2], '')))
    FROM top WHERE len(h) > 1),
steps AS (
    SELECT tree, level, h FROM levels WHERE len(h) > 1),
high AS (
    SELECT level, h FROM top WHERE len(h) > 1),
climbed AS (
    SELECT tree, place AS own, 0 AS level, place AS i, CASE WHEN tampered AND doc_id IS NOT NULL THEN altered ELSE leaf END AS folded, '' AS siblings
    FROM placed
    UNION ALL
    SELECT c.tree, own, c.level + 1, i // 2,
           CASE WHEN i % 2 = 1 THEN sha256(s.h[i] || folded) ELSE sha256(folded || coalesce(s.h[i + 2], '')) END,
           siblings || coalesce(CASE WHEN i % 2 = 1 THEN s.h[i] ELSE s.h[i + 2] END, '')
    FROM climbed c JOIN steps s ON c.tree = s.tree AND c.level = s.level),
at_subroot AS (
    SELECT tree, own, folded, siblings FROM climbed QUALIFY row_number() OVER (PARTITION BY tree, own ORDER BY level DESC) = 1),
finished AS (
    SELECT tree, own, 0 AS level, tree AS i, folded, siblings FROM at_subroot
    UNION ALL
    SELECT c.tree, own, c.level + 1, i // 2,
           CASE WHEN i % 2 = 1 THEN sha256(s.h[i] || folded) ELSE sha256(folded || coalesce(s.h[i + 2], '')) END,
           siblings || coalesce(CASE WHEN i % 2 = 1 THEN s.h[i] ELSE s.h[i + 2] END, '')
    FROM finished c JOIN high s ON c.level = s.level),
ends AS (
    SELECT tree, own, folded, siblings FROM finished QUALIFY row_number() OVER (PARTITION BY tree, own ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroot, r.h[1] AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = r.h[1] AS verified
FROM placed JOIN subroots USING (tree) JOIN ends e ON e.tree = placed.tree AND e.own = place
CROSS JOIN (SELECT h FROM top WHERE len(h) = 1) r""",
    "op12_source_divergence": r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
tokens AS (
    SELECT row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
    SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
counts AS (
    SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
    SELECT DISTINCT lang, source FROM docs),
dense AS (
    SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN counts USING (lang, source, term)),
shares AS (
    SELECT lang, source, term, n, 1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p
    FROM dense),
whole AS (
    SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term),
lang_shares AS (
    SELECT lang, term, 1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM whole),
distances AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
results AS (
    SELECT g.lang, g.source, 'pair' AS part, o.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
    FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
    LEFT JOIN distances d ON d.lang = g.lang AND d.source = g.source AND d.item = o.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM results QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 50""",
    "op13_rule_table": r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (
    SELECT row, doc_id, lang, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM docs),
windows AS (
    SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
repeated AS (
    SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, w) > 1),
covered AS (
    SELECT row, count(DISTINCT i + k) AS n FROM repeated CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) GROUP BY row),
measured AS (
    SELECT doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
           len(list_filter(words, lambda w: list_contains(string_split('{stop}', ' '), lower(trim(w, '.,;:()"'''))))) AS n_stop
    FROM split LEFT JOIN covered USING (row)),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.5 AND 12.0 AND n_symbols / n_words <= 0.3
       AND (lang IS NULL OR lang NOT IN ('en', 'de', 'fr', 'es') OR n_stop / n_words >= 0.05)
       AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.4) AS kept
FROM judged""".replace("{stop}", " ".join(rules.STOP_WORDS.values())),
}
