"""The named queries of this package over the standard tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    exact_dedup, lexical, mixing, packing, quality, repeats, set_join, sharding, token_counts, toxicity, url_filter, warc, whitening,
)
from tidemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), 2048)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), limit=1024)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (sharding.shard_documents(table(spark, sf_dir, "documents"), 8)
            .withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int")))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    back = warc.read_archives(warc.write_archives(warc.record_table(pages)), with_data=False)
    return back.where("last").select(F.col("record").cast(kind).alias("page_id"), F.col("n_bytes").alias("payload_bytes"),
                                     F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"),
                                     F.col("refers_to").cast(kind).alias("refers_to"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op8_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The remaining text comes along, so that the result can be judged by itself; a cut may fall inside a character.
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), 400, with_text=True)
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


RULES = [url_filter.Rule("allow", "com"), url_filter.Rule("block", "example.com", "/en/"), url_filter.Rule("allow", "www.example.com", "/en/"),
         url_filter.Rule("block", "net", "/es/"), url_filter.Rule("block", "net", "/fr/")]


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), 10)


OP10_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
     g AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""

OP4_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS words FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                                       ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
  l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
  r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) LEFT JOIN n USING (doc_id)
"""

OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
  b AS (SELECT page_id, h, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(strpos('123456789abcdef', x[i])), 4, '0')), '') AS bits FROM p),
  f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id,
          array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16 * bits[5 * i + 1]::INT + 8 * bits[5 * i + 2]::INT
            + 4 * bits[5 * i + 3]::INT + 2 * bits[5 * i + 4]::INT + bits[5 * i + 5]::INT]), '') AS payload_digest FROM b)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

#: The standard pages hold no redirects and no canonical links, so a rule or the default decides here.
OP12_SQL = r"""
WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
     r(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
     f AS (SELECT page_id, host, path, (SELECT max_by(struct_pack(rule := h || p, verdict := verdict), length(h || p)) FROM r
                                        WHERE ends_with('.' || host, '.' || h) AND starts_with(path, p)) AS won
           FROM (SELECT page_id, host, path FROM p))
SELECT page_id, host, path, won.rule AS rule, coalesce(won.verdict, 'allow') AS verdict FROM f
"""

OP13_SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
     p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
     l AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM p GROUP BY ALL),
     s AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM l),
     w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY ALL), s),
     i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
     r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
           FROM i JOIN w USING (term) JOIN p USING (term) JOIN l USING (doc_id), s GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM r WHERE score > 0
QUALIFY rank <= 10
"""

QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_best_fit_packing, op2_token_counts, op3_sharding, op4_ngram_jaccard, op5_warc, op6_mixing, op7_toxicity, op8_suffix_repeats, op9_quality_rules, op10_exact_dedup,
    op11_embedding_whitening, op12_url_filters, op13_lexical_search,
)}
ORACLES: dict[str, str] = {"op4_ngram_jaccard": OP4_SQL, "op5_warc": OP5_SQL, "op10_exact_dedup": OP10_SQL, "op12_url_filters": OP12_SQL, "op13_lexical_search": OP13_SQL}
