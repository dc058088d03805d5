"""The operators on the driver's tables: `(spark, sf_dir) -> DataFrame`, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from saleslake.llm.conversation_trie import prefix_trie
from saleslake.llm.html_extract import extract
from saleslake.llm.line_dedup import drop_boilerplate
from saleslake.llm.near_vectors import near_duplicates
from saleslake.llm.ngram_join import similar_components
from saleslake.llm.packing import pack
from saleslake.llm.quality import judge
from saleslake.llm.secret_scan import scan
from saleslake.llm.sentencepiece_codec import digests
from saleslake.llm.token_align import align_tokens
from saleslake.llm.top_k import top_k
from saleslake.llm.url_filter import filter_urls
from saleslake.llm.warc import archive_pages

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the fixed patterns and literals of sensitive names."""
    return scan(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that their source repeats on many of them."""
    return drop_boilerplate(_table(spark, sf_dir, "documents"), count=True).select(
        "doc_id", "source", "text", "n_lines", "n_dropped"
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-equal documents: five-word shingles, Jaccard of 0.8 or more."""
    return similar_components(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id"
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids in short, and whether decoding them gives the text again."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return digests(_table(spark, sf_dir, "documents"), path).withColumnRenamed("id", "doc_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in windows of 2048."""
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every document under limits of its language and source."""
    return judge(_table(spark, sf_dir, "documents"))


def op7_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return top_k(_table(spark, sf_dir, "embeddings")).selectExpr(
        "query_id", "cast(rank AS int) AS rank", "vec_id", "score"
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as legacy archives, converted to WARC and read back."""
    return archive_pages(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(_table(spark, sf_dir, "pages"))


# The rules that decide before the templates do.
URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every page's url.

    The last number of a page's path names the document it shows; a page is good if that
    document is labelled good and not toxic.
    """
    pages = _table(spark, sf_dir, "pages")
    shown = F.regexp_extract("url", r"/([0-9]{1,18})(?:\.[a-z]+)?/?(?:[?#].*)?$", 1)
    labels = _table(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")
    )
    marks = pages.select("page_id", shown.try_cast("long").alias("doc_id")).join(labels, "doc_id")
    judged = filter_urls(pages, marks.select(F.col("page_id").alias("id"), "good"), URL_RULES)
    return judged.select(
        F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "template", "purity"
    )


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of all documents' tokens under two tokenizers."""
    return align_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations."""
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of vectors of one label with a cosine of 0.98 or more."""
    return near_duplicates(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def queries() -> dict[str, Query]:
    """All queries by name."""
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_line_dedup": op2_line_dedup,
        "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_packing": op5_packing,
        "op6_quality_rules": op6_quality_rules,
        "op7_top_k_search": op7_top_k_search,
        "op8_warc": op8_warc,
        "op9_html_extraction": op9_html_extraction,
        "op10_url_filters": op10_url_filters,
        "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
        "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
        "op13_embedding_near_dedup": op13_embedding_near_dedup,
        "pipeline": corpus_pipeline.run,
    }


# A line's edge blanks: tab to CR and the space.
_BARE = "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

_LINE_DEDUP = f"""WITH lines AS (
  SELECT doc_id, source, place, line, {_BARE} AS bare
  FROM (SELECT doc_id, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
    FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts
      FROM documents WHERE text IS NOT NULL) d) l),
pages AS (SELECT source, COUNT(*) AS pages FROM documents GROUP BY source),
frequent AS (
  SELECT l.source, l.bare
  FROM (SELECT source, bare, COUNT(DISTINCT doc_id) AS n FROM lines WHERE bare <> ''
      GROUP BY source, bare) l
    JOIN pages p ON l.source IS NOT DISTINCT FROM p.source
  WHERE n > 1 AND pages >= 20 AND 10 * n > pages),
judged AS (
  SELECT l.*, f.bare IS NOT NULL AS dropped
  FROM lines l LEFT JOIN frequent f
    ON l.source IS NOT DISTINCT FROM f.source AND l.bare = f.bare),
texts AS (
  SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE dropped) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '') AS text
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, d.source, t.text, coalesce(t.n_lines, 0) AS n_lines,
  coalesce(t.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id"""


def _top_k_sql(vector: str = "embedding") -> str:
    """Every pair of a query and another row, scored, and the five best of each query."""
    return f"""WITH whole AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN {vector}] AS v
  FROM embeddings
  WHERE {vector} IS NOT NULL
    AND len([1 FOR x IN {vector} IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
    AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


# Distinct five-word shingles; texts with the same shingles once, and all that links reach.
_NGRAM = r"""WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS s
  FROM worded),
named AS (SELECT doc_id, len(s) AS n, sha256(array_to_string(s, chr(10))) AS name FROM sets),
classes AS (SELECT name, MIN(doc_id) AS id, ANY_VALUE(n) AS n FROM named WHERE n > 0 GROUP BY name),
tokens AS (
  SELECT c.id, c.n, unnest(s.s) AS token FROM classes c JOIN sets s ON s.doc_id = c.id),
common AS (
  SELECT a.id AS a, b.id AS b, a.n AS size_a, b.n AS size_b, COUNT(*) AS shared
  FROM tokens a JOIN tokens b ON a.token = b.token AND a.id < b.id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common WHERE 100 * shared >= 80 * (size_a + size_b - shared)
  UNION SELECT b, a FROM common WHERE 100 * shared >= 80 * (size_a + size_b - shared)),
reached AS (
  SELECT id AS a, id AS b FROM classes UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, MIN(b) AS low FROM reached GROUP BY a)
SELECT d.doc_id, d.n AS n_shingles, coalesce(l.low, d.doc_id) AS component_id
FROM named d LEFT JOIN classes c ON c.name = d.name AND d.n > 0 LEFT JOIN lowest l ON l.a = c.id"""

# A SHA-1 digest in base 32: eight times four letters from 20 bits.
_BASE32 = """array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31), 1)
    FOR k IN range(32)], '')"""
_WARC = f"""WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, MIN(page_id) AS first FROM payloads GROUP BY html),
hashed AS (SELECT p.page_id, octet_length(encode(p.html)) AS bytes, sha1(p.html) AS hex, f.first
  FROM payloads p JOIN firsts f ON f.html = p.html)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed"""

# Every pair of a label, and all that can be reached from each vector.
_NEAR_VECTORS = """WITH RECURSIVE whole AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([1 FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM whole a JOIN whole b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM whole
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
counts AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a),
lowest AS (SELECT a, MIN(b) AS low FROM reached GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(low, vec_id) AS component_id,
  coalesce(vec_id = coalesce(low, vec_id), FALSE) AS kept
FROM embeddings LEFT JOIN counts c ON vec_id = c.a LEFT JOIN lowest l ON vec_id = l.a"""


# A decimal's CRC-32, bit by bit: the sign and digits through the reversed polynomial.
_CRC32 = """xor(list_reduce(list_concat([4294967295], [CAST(ascii(x) AS BIGINT)
    FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, turn: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"""

# Whole sequences of turns as keys.
_TRIE = f"""WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, MAX(pos) AS len, {_CRC32} % 4 AS h FROM turns GROUP BY conv_id),
planned AS (
  SELECT c.conv_id, c.h, b.conv_id AS base, least(c.h, coalesce(b.len, 0)) AS head,
    least(c.h, coalesce(b.len, 0)) + greatest(c.len - c.h, 0) AS size
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20),
rebuilt AS (
  SELECT p.conv_id, p.size, t.pos AS d, role, text
  FROM planned p JOIN turns t ON t.conv_id = p.base AND t.pos <= p.head
  UNION ALL
  SELECT p.conv_id, p.size, p.head + t.pos - p.h, role, text
  FROM planned p JOIN turns t ON t.conv_id = p.conv_id AND t.pos > p.h),
members AS (
  SELECT conv_id, size, d, text AS last, list(sha256(concat(len(role), ':', role, text)))
    OVER (PARTITION BY conv_id ORDER BY d) AS path
  FROM rebuilt
  UNION ALL SELECT conv_id, size, 0, '', CAST([] AS VARCHAR[]) FROM planned),
nodes AS (
  SELECT path, d, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs,
    (COUNT(*) - 1) * len(regexp_extract_all(MIN(last), '[^\\x20\\x09-\\x0D]+')) AS saved,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
      FILTER (WHERE size = d), '') AS ends
  FROM members GROUP BY path, d),
children AS (
  SELECT p.path, COUNT(*) AS n FROM nodes p JOIN nodes c ON c.d > 0 AND c.path[1:c.d - 1] = p.path
  GROUP BY p.path),
below AS (
  SELECT m.path, SUM(u.saved) AS saved, COUNT(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM nodes u JOIN members m ON m.conv_id = u.conv_id AND m.d <= u.d
    LEFT JOIN children c ON c.path = u.path
  GROUP BY m.path)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs,
  coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN children c ON c.path = n.path
  LEFT JOIN nodes p ON n.d > 0 AND p.path = n.path[1:n.d - 1]"""


_QUALITY = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT r, doc_id, lang, source, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts),
placed AS (
  SELECT r, unnest(words) AS word, unnest(range(len(words))) AS pos FROM split),
windows AS (
  SELECT r, pos, lead(word, 7) OVER o AS eighth, concat_ws(' ', word, lead(word, 1) OVER o,
    lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o,
    lead(word, 6) OVER o, lead(word, 7) OVER o) AS said
  FROM placed WINDOW o AS (PARTITION BY r ORDER BY pos)),
again AS (
  SELECT r, pos FROM windows WHERE eighth IS NOT NULL
  QUALIFY COUNT(*) OVER (PARTITION BY r, said) > 1),
covered AS (
  SELECT r, COUNT(DISTINCT pos + step) AS n FROM again, range(8) AS steps(step) GROUP BY r),
counted AS (
  SELECT r, doc_id, lang, source, len(words) AS n_words, len(lines) AS n_lines,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)),
based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted),
measures AS (
  SELECT r, lang, source, base_failed, unnest([
    {'m': 0, 'spread': 150, 'v': 100 * word_chars // greatest(n_words, 1)},
    {'m': 1, 'spread': 100, 'v': 1000 * n_symbols // greatest(n_words, 1)},
    {'m': 2, 'spread': 150, 'v': 1000 * n_dup_lines // greatest(n_lines, 1)},
    {'m': 3, 'spread': 100, 'v': 1000 * n_repeat_words // greatest(n_words, 1)}], recursive := true)
  FROM based),
edges AS (
  SELECT *, greatest(length(ltrim(bin(CAST(v AS BIGINT)), '0')) - 6, 0) AS low_bits
  FROM measures WHERE NOT base_failed),
leveled AS (
  SELECT unnest([0, 1, 2]) AS level, lang, source, m, spread,
    v // CAST(pow(2, low_bits) AS BIGINT) * CAST(pow(2, low_bits) AS BIGINT) AS bucket
  FROM edges),
pooled AS (
  SELECT level, CASE WHEN level < 2 THEN lang END AS lang, CASE WHEN level = 0 THEN source END
    AS source, m, spread, bucket, COUNT(*) AS n
  FROM leveled GROUP BY ALL),
ranked AS (
  SELECT *, SUM(n) OVER (o ORDER BY bucket) AS upto, SUM(n) OVER o AS total
  FROM pooled WINDOW o AS (PARTITION BY level, lang, source, m)),
quartiles AS (
  SELECT level, lang, source, m, spread, total,
    MIN(bucket) FILTER (upto >= ceil(total * 0.25)) AS low,
    MIN(bucket) FILTER (upto >= ceil(total * 0.5)) AS middle,
    MIN(bucket) FILTER (upto >= ceil(total * 0.75)) AS high
  FROM ranked GROUP BY ALL),
bounds AS (
  SELECT level, lang, source, m, total, low - 3 * greatest(middle - low, spread) AS least,
    high + 3 * greatest(high - middle, spread) AS most
  FROM quartiles),
usable AS (SELECT * FROM bounds WHERE level = 2 OR total >= 100),
judged AS (
  SELECT x.r, x.v < b.least OR x.v > b.most AS outside
  FROM measures x JOIN usable b ON b.m = x.m
    AND (b.level = 2 OR b.lang IS NOT DISTINCT FROM x.lang)
    AND (b.level > 0 OR b.source IS NOT DISTINCT FROM x.source)
  QUALIFY row_number() OVER (PARTITION BY x.r, x.m ORDER BY b.level) = 1),
rejected AS (SELECT DISTINCT r FROM judged WHERE outside)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM rejected) AS kept
FROM based"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express."""
    return {
        "op2_line_dedup": _LINE_DEDUP,
        "op3_ngram_jaccard_join": _NGRAM,
        "op6_quality_rules": _QUALITY,
        "op7_top_k_search": _top_k_sql(),
        "op8_warc": _WARC,
        "op12_conversation_prefix_trie": _TRIE,
        "op13_embedding_near_dedup": _NEAR_VECTORS,
    }
