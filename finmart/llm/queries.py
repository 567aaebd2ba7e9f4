"""The registered queries of the operators, and the SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.llm import (
    collocations,
    decontaminate,
    divergence,
    embedding_dedup,
    extraction,
    jaccard_join,
    licenses,
    lm_score,
    packing,
    quality,
    sharding,
    token_store,
    warc,
)
from finmart.llm.base import table

SHARDS = 24
QUALITY_THRESHOLD = 0.3


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-polytope hashing of all vectors, links of cosine 0.95 or more."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of near equal bytes by sampled splitters."""
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against the ten-word windows of the benchmark."""
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.report(found).withColumnRenamed("id", "doc_id")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities by the hashed maximum-entropy model."""
    return lm_score.score_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices by the positional index of rare words."""
    return licenses.report(*licenses.scan(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by 4-word shingles of Jaccard similarity 0.85 or more."""
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality by nearest labelled texts in the latent-semantic space."""
    docs = table(spark, sf_dir, "documents")
    space = quality.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    return quality.score(docs, space).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as response records in WARC files, read back, derived, written and read back again."""
    folder, files = warc.write_warc(warc.responses(table(spark, sf_dir, "pages")))
    folder, files = warc.write_warc(warc.derivatives(warc.read_warc(folder, files)))
    return warc.report(warc.read_warc(folder, files))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written to binary files and read back."""
    folder, manifest = token_store.write_tokens(table(spark, sf_dir, "documents"))
    return token_store.read_tokens(folder, manifest).withColumnRenamed("id", "doc_id")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of 2 to 5 words by grouped word prefixes and depth-truncated suffix subtrees."""
    return collocations.phrases(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources against each other and against their language, by merged stripes."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page by boosted trees over its nodes."""
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.fit(pages))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_embedding_dedup, op2_sharding, op3_decontamination, op4_lm_score, op5_license_scan, op6_jaccard_join,
        op7_quality, op8_warc_derivatives, op9_packing, op10_token_store, op11_phrase_collocations,
        op12_source_divergence, op13_html_extraction)}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# components of a symmetric relation links(a, b): the least node that each reaches
_REACHED = """reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
lowest AS (SELECT a, min(b) AS root FROM reach GROUP BY a)"""

SQL: dict[str, str] = {
    "op1_embedding_dedup": f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sound AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
{_REACHED},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(root, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(root, vec_id)) AS kept
FROM v LEFT JOIN counts ON counts.a = vec_id LEFT JOIN lowest ON lowest.a = vec_id""",
    "op6_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS words FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + least(len(words), 4) - 1], ' ') AS s
         FROM (SELECT doc_id, words, unnest(range(1, len(words) - least(len(words), 4) + 2)) AS i FROM d WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
{_REACHED},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT d.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(root, d.doc_id)) AS component_id,
       CAST(coalesce(counts.n, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN counts ON counts.a = d.doc_id LEFT JOIN lowest ON lowest.a = d.doc_id""",
    # windows by length, occurrences by an equal join, hit words by the union of the windows that cover them
    "op3_decontamination": f"""
WITH items AS (SELECT item_id, {_ALNUM} AS words FROM benchmark),
docs AS (SELECT doc_id, {_ALNUM} AS words FROM documents),
wins AS (SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS win
         FROM (SELECT item_id, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM items WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT n FROM wins),
runs AS (SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS win
         FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, lengths WHERE len(words) >= n)),
hits AS (SELECT doc_id, i, runs.n, item_id FROM runs JOIN wins USING (n, win)),
covered AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS items FROM hits GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    # every kept term against every group of its language; hugeint arithmetic
    "op12_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT doc, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
cells AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
grp AS (SELECT DISTINCT lang, source FROM d),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
totals AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT + 5 * coalesce(any_value(v), 0) AS total
           FROM grp LEFT JOIN cells USING (lang, source) LEFT JOIN sizes USING (lang) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // total AS p
      FROM totals JOIN kept USING (lang) LEFT JOIN cells USING (lang, source, term)),
whole AS (SELECT lang, sum(n)::HUGEINT + 5 * any_value(v) AS total FROM cells JOIN sizes USING (lang) GROUP BY lang),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n)::HUGEINT + 5)) // any_value(total) AS q
      FROM cells JOIN whole USING (lang) GROUP BY lang, term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 50""",
    # every run of 1 to 5 words as one string; containment by all inner runs
    "op11_phrase_collocations": r"""
WITH pieces AS (SELECT row_number() OVER () AS piece, lang, words FROM (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
  FROM documents) WHERE len(words) > 0),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
runs AS (SELECT lang, words[i:i + k] AS w FROM places, range(5) t(k) WHERE i + k <= len(words)),
total AS (SELECT lang, sum(len(words))::HUGEINT AS n FROM pieces GROUP BY lang),
f AS (SELECT lang, w, count(*)::HUGEINT AS f FROM runs GROUP BY lang, w HAVING count(*) >= 100),
cand AS (SELECT lang, w, f AS a FROM f WHERE len(w) > 1),
inner_runs AS (SELECT lang, a, w[s:s + m - 1] AS w FROM (
  SELECT lang, a, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM (SELECT lang, a, w, unnest(range(2, len(w))) AS m FROM cand))),
covered AS (SELECT lang, w, max(a) AS longer FROM inner_runs GROUP BY lang, w),
kept AS (SELECT cand.* FROM cand LEFT JOIN covered USING (lang, w) WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (SELECT k.lang, k.w, k.a, c, x.f AS l, y.f AS r, n, (1000 * k.a * n) // (x.f * y.f) AS score
         FROM (SELECT *, unnest(range(1, len(w))) AS c FROM kept) k
         JOIN f x ON x.lang = k.lang AND x.w = k.w[1:c] JOIN f y ON y.lang = k.lang AND y.w = k.w[c + 1:len(k.w)]
         JOIN total ON total.lang = k.lang),
worst AS (SELECT *, array_to_string(w, ' ') AS phrase FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a,
       CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM worst QUALIFY rank <= 2000""",
}
