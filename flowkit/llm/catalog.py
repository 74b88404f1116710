"""The operators as queries over whole tables, with their SQL where it can be said."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.llm.contamination import find_leaks
from flowkit.llm.negatives import mine_negatives
from flowkit.llm.phrases import find_phrases
from flowkit.llm.pieces import piece_digests
from flowkit.llm.quality import judge_documents
from flowkit.llm.ranking import score_quality
from flowkit.llm.secrets import scan_secrets
from flowkit.llm.simhash import near_duplicates
from flowkit.llm.substrings import substring_dedup
from flowkit.llm.suffixes import suffix_dedup
from flowkit.llm.tokens import token_files
from flowkit.llm.urls import judge_urls
from flowkit.llm.warc import archive_pages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query(
    """
    WITH words AS (
      SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS w
      FROM documents),
    windows AS (
      SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)),
    firsts AS (SELECT win, min(doc_id) AS least FROM windows GROUP BY win HAVING count(*) > 1),
    later AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
      FROM windows JOIN firsts USING (win) WHERE least < doc_id),
    each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
    kept AS (
      SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
      FROM each ANTI JOIN later USING (doc_id, i) GROUP BY doc_id)
    SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
      CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)
    LEFT JOIN (SELECT doc_id, count(*) AS n FROM later GROUP BY doc_id) r USING (doc_id)
    """
)
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that no earlier document's run of 13 words covers."""
    return substring_dedup(_table(spark, folder, "documents")).select(
        "doc_id",
        F.col("n_symbols").alias("n_words"),
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query(
    """
    WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    windows AS (
      SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 100) AS win
      FROM (SELECT doc_id, h, unnest(range(0, CAST(len(h) // 2 - 49 AS BIGINT))) AS i FROM bytes)),
    firsts AS (SELECT win, min(doc_id) AS least FROM windows GROUP BY win HAVING count(*) > 1),
    later AS (SELECT doc_id, i FROM windows JOIN firsts USING (win) WHERE least < doc_id),
    marked AS (
      SELECT doc_id, i, CASE WHEN i <= max(i) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 50 THEN 0 ELSE 1 END AS new
      FROM later),
    runs AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
    spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run),
    gaps AS (
      SELECT doc_id, b AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), len(h) // 2) AS b
      FROM (SELECT doc_id, a, b FROM spans UNION ALL SELECT doc_id, -1, 0 FROM bytes) JOIN bytes USING (doc_id)),
    kept AS (
      SELECT doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS h
      FROM gaps JOIN bytes USING (doc_id) WHERE b > a GROUP BY doc_id)
    SELECT bytes.doc_id, CAST(len(bytes.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(s.n, 0) AS BIGINT) AS n_removed,
      CAST(coalesce(s.spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
    FROM bytes LEFT JOIN kept USING (doc_id)
    LEFT JOIN (SELECT doc_id, sum(b - a) AS n, count(*) AS spans FROM spans GROUP BY doc_id) s USING (doc_id)
    """
)
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of each document that no earlier document's 50-byte string covers."""
    return suffix_dedup(_table(spark, folder, "documents")).select(
        "doc_id",
        F.col("n_symbols").alias("n_bytes"),
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query(
    """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest
      FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY digest, n) AS least FROM p)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
      CASE WHEN n >= 100 AND page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN n >= 100 AND page_id > least THEN least END AS refers_to, TRUE AS digest_ok
    FROM f
    """
)
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as WARC records and read back by their chain of boundaries."""
    return archive_pages(_table(spark, folder, "pages"))


# The rules on hosts and paths.
_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@_query(
    """
    WITH cut AS (
      SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    parts AS (
      SELECT page_id, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
      ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
    fit AS (
      SELECT page_id, arg_max(h || p, len(h || p)) AS rule, arg_max(verdict, len(h || p)) AS verdict
      FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
    seen AS (
      SELECT host, CASE WHEN toxic = 1 OR quality = 0 THEN 1 WHEN toxic = 0 AND quality = 1 THEN 0 END AS bad
      FROM parts LEFT JOIN labels ON doc_id = page_id),
    hosts AS (
      SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad,
        regexp_extract(host, '([^.]*\\.)?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix
      FROM seen GROUP BY host),
    domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
    suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
    total AS (SELECT sum(n) AS n, sum(bad) AS bad FROM suffixes),
    pairs AS (
      SELECT 1 AS level, s.n, s.bad, t.bad / t.n AS p FROM suffixes s, total t WHERE s.n > 0
      UNION ALL SELECT 2, d.n, d.bad, s.bad / s.n FROM domains d JOIN suffixes s USING (suffix) WHERE d.n > 0
      UNION ALL SELECT 3, h.n, h.bad, d.bad / d.n FROM hosts h JOIN domains d USING (domain) WHERE h.n > 0),
    sums AS (
      SELECT level, sum(n * (bad / n - p) ** 2) - sum(p * (1 - p)) AS over, sum((n - 1) * p * (1 - p)) AS room
      FROM pairs GROUP BY level),
    strong AS (
      SELECT level, 1 / least(0.999, greatest(1e-3, CASE WHEN room <> 0 THEN over / room ELSE 0 END)) - 1 AS s FROM sums),
    r0 AS (SELECT (bad + 0.5) / (n + 1.0) AS rate, n + 1.0 AS size FROM total),
    r1 AS (
      SELECT suffix, (bad + least(s, size) * rate) / (n + least(s, size)) AS rate, n + least(s, size) AS size
      FROM suffixes, r0, strong WHERE level = 1),
    r2 AS (
      SELECT domain, (d.bad + least(s, size) * rate) / (d.n + least(s, size)) AS rate, d.n + least(s, size) AS size
      FROM domains d JOIN r1 USING (suffix), strong WHERE level = 2),
    r3 AS (
      SELECT host, (h.bad + least(s, size) * rate) / (h.n + least(s, size)) AS rate, h.n + least(s, size) AS size
      FROM hosts h JOIN r2 USING (domain), strong WHERE level = 3),
    shapes AS (SELECT host, rate * size AS a, (1 - rate) * size AS b, 0.5 < (a + 1) / (size + 2) AS below FROM r3),
    turned AS (SELECT host, below, CASE WHEN below THEN a ELSE b END AS a, CASE WHEN below THEN b ELSE a END AS b FROM shapes),
    beta AS (
      SELECT host, below, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + (a + b) * ln(0.5)) / a
        / list_reduce(list_prepend(1.0::DOUBLE, list_transform(range(600, 0, -1), lambda k: k::DOUBLE)), lambda f, k: 1 +
          CASE WHEN k % 2 = 0 THEN k / 2 * (b - k / 2) * 0.5 / ((a + k - 1) * (a + k))
          ELSE -(a + (k - 1) / 2) * (a + b + (k - 1) / 2) * 0.5 / ((a + k - 1) * (a + k)) END / f) AS part
      FROM turned),
    bad_hosts AS (SELECT host FROM beta WHERE CASE WHEN below THEN part ELSE 1 - part END <= 0.05)
    SELECT page_id, host, path, rule, coalesce(fit.verdict, CASE WHEN b.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
    FROM parts LEFT JOIN fit USING (page_id) LEFT JOIN bad_hosts b USING (host)
    """
)
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on pages by rules, else by the reputation of their hosts.

    The label of a page is the row of ``labels`` with its number: bad if toxic
    or of low quality.
    """
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(
        (F.col("toxic") == 0) & (F.col("quality") == 1), 0
    )
    labels = _table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judge_urls(_table(spark, folder, "pages"), labels, _RULES)


@_query()
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids written as wavelet matrices and read back."""
    return token_files(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query()
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of near-duplicates of each document."""
    return near_duplicates(_table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


@_query(
    """
    WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
    w AS (
      SELECT *, list_filter(string_split_regex(text, '[ \\t-\\r]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines
      FROM t),
    wins AS (
      SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS win
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
    twice AS (SELECT doc_id, win FROM wins GROUP BY doc_id, win HAVING count(*) > 1),
    rep AS (
      SELECT doc_id, count(DISTINCT i + k) AS n
      FROM (SELECT doc_id, i, unnest(range(0, 5)) AS k FROM wins SEMI JOIN twice USING (doc_id, win)) GROUP BY doc_id),
    m AS (
      SELECT w.doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
        CAST(len(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep USING (doc_id)),
    j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
    h AS (
      SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(base_failed AS INT)) AS DOUBLE) AS f
      FROM j WHERE source IS NOT NULL GROUP BY source),
    s AS (SELECT count(*) AS k, sum(n) AS n, sum(f) / sum(n) AS p, sum(n * n) AS q FROM h),
    v AS (
      SELECT any_value(p) AS p,
        (sum(h.n * (f / h.n - p) ** 2) - (any_value(k) - 1) * any_value(p * (1 - p))) / any_value(s.n - q / s.n) AS b
      FROM h, s),
    prior AS (SELECT p, CASE WHEN b > 0 THEN least(1e6, greatest(1e-3, p * (1 - p) / b - 1)) ELSE 1e6 END AS a FROM v),
    rates AS (SELECT source, (f + p * a) / (n + a) AS r, n + a + 1 AS size FROM h, prior),
    bad AS (SELECT source FROM rates WHERE r - 2 * sqrt(r * (1 - r) / size) > 0.9)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND bad.source IS NULL AS kept
    FROM j LEFT JOIN bad USING (source)
    """
)
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of each document, and whether it is kept."""
    return judge_documents(_table(spark, folder, "documents"))


@_query()
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in each document: matches of the base patterns, and what the network adds."""
    return scan_secrets(_table(spark, folder, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


@_query()
def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Documents encoded to pieces and decoded again."""
    return piece_digests(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query()
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the test items they hold, within eight edits in a hundred characters."""
    return find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query(
    """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
      SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
        CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
      FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
    positives AS (
      SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scores WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5)
    SELECT anchor_id, positive_id,
      CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, row_id) AS INTEGER) AS rank,
      row_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3
    """
)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """For each anchor and positive the hardest rows of other labels; every seventh row has a label of noise."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(_table(spark, folder, "embeddings").withColumn("label", label))


@_query(
    """
    WITH texts AS (
      SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents),
    pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\n-\r]')) AS piece FROM texts),
    lists AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
    grams AS (
      SELECT lang, k, w[i:i + k - 1] AS g
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, (VALUES (1), (2), (3)) s(k))),
    f AS (SELECT lang, k, g, CAST(count(*) AS BIGINT) AS c FROM grams GROUP BY lang, k, g),
    total AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    found AS (SELECT * FROM f WHERE k > 1 AND c >= 10),
    cuts AS (
      SELECT b.lang, b.g, b.c AS a, x.c AS l, y.c AS r, j,
        CAST((1000000 * CAST(b.c AS HUGEINT) * b.c) // (CAST(x.c AS HUGEINT) * y.c) AS BIGINT) AS score
      FROM (SELECT *, unnest(range(1, k)) AS j FROM found) b
      JOIN f x ON x.lang = b.lang AND x.g = b.g[1:j] JOIN f y ON y.lang = b.lang AND y.g = b.g[j + 1:]),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
    inner_ones AS (
      SELECT lang, g, max(c) AS most
      FROM (SELECT lang, g[1:2] AS g, c FROM found WHERE k = 3 UNION ALL SELECT lang, g[2:3], c FROM found WHERE k = 3)
      GROUP BY lang, g),
    kept AS (
      SELECT best.* FROM best LEFT JOIN inner_ones USING (lang, g) WHERE most IS NULL OR 100 * most < 50 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
      array_to_string(g, ' ') AS phrase, a, l, r, n, score
    FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
    """
)
def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The best collocations of two and three words in each language."""
    return find_phrases(_table(spark, folder, "documents"))


@_query()
def op13_quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of each document, learned from pairs of labelled ones."""
    return score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
