"""Queries of the corpus: chunk choice, the packer, the clean corpus and its statistics, with oracles that fold in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html
from ..operators import assembly, chunking
from .queries import _LEGAL_SQL, _duck_strip, _legal, query, t


def _packed_sql(source: str) -> str:
    """Tables that end in packed(k, piece, x), the packed chunks of source(k, text); for use after WITH RECURSIVE."""
    strip = _duck_strip
    tidy = lambda c: strip(rf"regexp_replace(regexp_replace(replace({c}, chr(0), ' '), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")
    parts = lambda by: f"list_filter(list_transform(string_split({by}, chr(1)), lambda y: {strip('y')}), lambda y: y <> '')"
    windows = lambda c: f"list_filter(list_transform(range(0, length({c}), 1220), lambda s: {strip(f'substr({c}, CAST(s + 1 AS INT), 1400)')}), lambda y: y <> '')"
    return rf"""
tid AS (SELECT k, {tidy("coalesce(text, '')")} AS x FROM {source}),
div AS (SELECT k, x, {parts(r"regexp_replace(x, '\n\s*\n', chr(1), 'g')")} AS pars, {parts(r"regexp_replace(x, '([.!?。;:])\s+', '\1' || chr(1), 'g')")} AS sents,
  list_transform(range(0, length(x), 1400), lambda s: substr(x, CAST(s + 1 AS INT), 1400)) AS slices FROM tid WHERE length(x) > 1400),
part AS (SELECT k, CASE WHEN len(pars) > 1 THEN pars WHEN len(sents) > 1 THEN sents ELSE slices END AS p FROM div),
fold(k, i, held, done) AS (
  SELECT k, 0, '', CAST([] AS VARCHAR[]) FROM part
  UNION ALL
  SELECT k, i + 1, CASE WHEN length(x) > 1400 THEN '' WHEN length(joined) <= 1400 THEN joined WHEN len(closed) > 0 THEN {strip("right(closed[len(closed)], 180)")} || chr(10) || x ELSE x END,
    CASE WHEN length(x) > 1400 THEN list_concat(list_concat(done, CASE WHEN held <> '' THEN [{strip('held')}] ELSE [] END), list_filter({windows('x')}, lambda y: length(y) >= 40))
      WHEN length(joined) <= 1400 THEN done ELSE closed END
  FROM (SELECT f.k, f.i, f.held, f.done, p[i + 1] AS x, CASE WHEN held = '' THEN p[i + 1] ELSE held || chr(10) || p[i + 1] END AS joined,
      CASE WHEN length(held) >= 40 THEN list_append(done, {strip('held')}) ELSE done END AS closed
    FROM fold f JOIN part ON part.k = f.k WHERE i < len(p))
),
filled AS (SELECT f.k, CASE WHEN length(held) >= 40 THEN list_append(done, {strip('held')}) ELSE done END AS done FROM fold f JOIN part ON part.k = f.k WHERE i = len(p)
  UNION ALL SELECT k, [x] FROM tid WHERE length(x) <= 1400 AND x <> ''),
piece AS (SELECT k, flatten(list_transform(done, lambda c: CASE WHEN length({tidy('c')}) > 1400 THEN list_transform({windows(tidy('c'))}, lambda y: {tidy('y')}) ELSE [{tidy('c')}] END)) AS p FROM filled),
settle(k, i, done) AS (
  SELECT k, 0, CAST([] AS VARCHAR[]) FROM piece
  UNION ALL
  SELECT s.k, i + 1, CASE WHEN length(p[i + 1]) >= 40 THEN list_append(done, p[i + 1])
    WHEN p[i + 1] <> '' AND len(done) > 0 AND length(done[len(done)]) + 1 + length(p[i + 1]) <= 1400 THEN list_append(done[1:len(done) - 1], done[len(done)] || chr(10) || p[i + 1]) ELSE done END
  FROM settle s JOIN piece ON piece.k = s.k WHERE i < len(p)
),
packed AS (SELECT k, unnest(done) AS x, generate_subscripts(done, 1) AS piece FROM (SELECT s.k, done FROM settle s JOIN piece ON piece.k = s.k WHERE i = len(p)))"""


@query(
    f"""WITH RECURSIVE src AS (SELECT doc_id AS k, text FROM documents),{_packed_sql('src')}
SELECT k AS doc_id, lang, printf('%s:content_clean:%05d:%03d', CAST(k AS VARCHAR), 1, piece) AS chunk_id, 'content_clean' AS source, 'content_clean' AS source_level, x AS text,
  CAST(length(x) AS INT) AS char_count, CAST(greatest(1, length(x) // 4) AS INT) AS token_estimate, false AS needs_ocr FROM packed JOIN documents ON doc_id = k"""
)
def packed_chunks(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return chunking.packed_chunks(d, "doc_id", "text", "content_clean")


@query(
    _LEGAL_SQL
    + f""", h AS (SELECT *, CASE WHEN article_title <> '' THEN 'Điều ' || article_number || '. ' || article_title ELSE 'Điều ' || article_number END AS head FROM parts WHERE content <> ''),
ch AS (SELECT *, CASE level WHEN 'article' THEN head || chr(10) || content WHEN 'clause' THEN head || chr(10) || 'Khoản ' || clause_number || '. ' || content ELSE head || chr(10) || 'Khoản ' || clause_number || chr(10) || 'Điểm ' || point_key || '. ' || content END AS chunk FROM h),
own AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY a, c, p) AS chunk_no, level, article_number, clause_number, point_key, chunk FROM ch
  WHERE length(chunk) >= 80 AND doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')),
said AS (SELECT doc_id, string_agg(CASE kind WHEN 'article' THEN 'Điều ' || n || '. ' || x WHEN 'clause' THEN n || '. ' || x WHEN 'point' THEN 'a) ' || x ELSE x END, chr(10) ORDER BY i) AS said FROM m GROUP BY doc_id),
d AS (SELECT doc_id, {_duck_strip("regexp_replace(CASE WHEN lang = 'en' THEN coalesce(said, '') ELSE coalesce(text, '') END, '[ \t]+', ' ', 'g')")} AS x FROM documents LEFT JOIN said USING (doc_id) WHERE doc_id NOT IN (SELECT doc_id FROM own)),
win AS (SELECT doc_id, s, {_duck_strip("substr(x, CAST(s + 1 AS INT), 1400)")} AS chunk FROM (SELECT doc_id, x, unnest(range(0, CAST(greatest(ceil((length(x) - 1400) / 1180.0), 0) AS BIGINT) * 1180 + 1, 1180)) AS s FROM d)),
every AS (SELECT * FROM own UNION ALL SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s), 'fallback', '', '', '', chunk FROM win WHERE chunk <> '')
SELECT doc_id, CAST(chunk_no AS INT) AS chunk_no, level, article_number, clause_number, point_key, chunk, CAST(length(chunk) AS INT) AS char_count FROM every"""
)
def chosen_chunks(spark, sf_dir):
    """Articles of documents that have headings (the English ones are given some), windows of all others."""
    marked = _legal(spark, sf_dir).withColumnRenamed("text", "marked")
    d = t(spark, sf_dir, "documents").join(marked, "doc_id").select("doc_id", F.when(F.col("lang") == "en", F.col("marked")).otherwise(F.col("text")).alias("body"))
    return chunking.chosen_chunks(d, "doc_id", "body")


def _corpus(spark, sf_dir):
    """Inputs of the clean corpus from documents: English ones have chunks (one for each line), German ones content,
    Spanish ones PDF text, French ones a PDF without text, and others nothing."""
    d = t(spark, sf_dir, "documents").withColumn("key", F.col("doc_id").cast("string"))
    is_ = lambda lang: F.col("lang") == lang
    docs = d.select("key", F.lit(1).alias("v"), "source", F.when(is_("de"), F.col("text")).otherwise("").alias("content_clean"), F.when(is_("es") | is_("fr"), F.array(F.lit("u"))).otherwise(F.array().cast("array<string>")).alias("pdf_urls"))
    docs = docs.withColumnRenamed("source", "agency")
    lines = d.where(is_("en")).select("key", F.posexplode(F.split("text", "\n")).alias("chunk_no", "text")).withColumn("level", F.lit("line"))
    pdfs = d.where(is_("es") | is_("fr")).select("key", F.when(is_("es"), F.col("text")).otherwise("").alias("text"), F.lit("u").alias("pdf_url"), F.when(is_("fr"), "pdf_too_large").otherwise("").alias("issue"))
    return assembly.clean_corpus(docs, lines, "key", "v", "chunk_no", pdfs)


_CORPUS_SQL = f"""WITH RECURSIVE line AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE lang = 'en'),
clean AS (SELECT doc_id, {_duck_strip(r"regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')")} AS x FROM documents WHERE lang = 'de'),
src AS (SELECT doc_id || '/crawler_chunk/line/' || i AS k, text FROM line UNION ALL SELECT doc_id || '/content_clean/document/1', text FROM documents WHERE lang = 'de'
  UNION ALL SELECT doc_id || '/pdf_text/document/1', text FROM documents WHERE lang = 'es'),{_packed_sql('src')},
chunk AS (SELECT split_part(k, '/', 1) AS key, split_part(k, '/', 2) AS source, split_part(k, '/', 3) AS source_level, CAST(split_part(k, '/', 4) AS INT) AS i, piece, x FROM packed),
issue AS (SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN lang IN ('es', 'fr') THEN 'needs_ocr' ELSE 'missing_text' END AS issue, CASE WHEN lang IN ('es', 'fr') THEN 1 ELSE 0 END AS n, CASE lang WHEN 'fr' THEN 'pdf_too_large' ELSE '' END AS why
  FROM documents WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT key FROM chunk) AND doc_id NOT IN (SELECT doc_id FROM clean WHERE x <> ''))"""


@query(
    _CORPUS_SQL
    + """ SELECT key, printf('%s:%s:%05d:%03d', key, source, i, piece) AS name, source, source_level, sha256(x) AS digest, CAST(length(x) AS INT) AS n FROM chunk
UNION ALL SELECT key, issue, 'issue', why, '', n FROM issue"""
)
def clean_corpus(spark, sf_dir):
    """Chunks from what each document has, in the order of preference, and an issue for those that give none."""
    chunks, issues = _corpus(spark, sf_dir)
    made = chunks.select("key", F.col("chunk_id").alias("name"), "source", "source_level", F.sha2("text", 256).alias("digest"), F.col("char_count").alias("n"))
    return made.unionByName(issues.select("key", F.col("issue").alias("name"), F.lit("issue").alias("source"), F.col("pdf_extract_issue").alias("source_level"), F.lit("").alias("digest"), F.col("pdf_url_count").alias("n")))


@query(
    _CORPUS_SQL
    + """ SELECT 'documents_from_' || source AS name, count(DISTINCT key) AS n FROM chunk GROUP BY source UNION ALL SELECT 'chunks', count(*) FROM chunk
UNION ALL SELECT name, count(*) FROM (SELECT issue AS name FROM issue UNION ALL SELECT why FROM issue) WHERE name <> '' GROUP BY name"""
)
def corpus_statistics(spark, sf_dir):
    chunks, issues = _corpus(spark, sf_dir)
    return assembly.statistics(chunks, issues, "key")


@query(
    r"""WITH a AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, regexp_extract(url, '^https?:', 0) AS scheme, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
  generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS i FROM pages),
u AS (SELECT page_id, i, CASE WHEN starts_with(href, '/') THEN scheme || '//' || host || href ELSE href END AS link FROM a WHERE href <> ''),
d AS (SELECT page_id, link, min(i) AS i FROM u WHERE suffix(regexp_extract(link, '^https?://([^/?#]*)', 1), 'example.com') GROUP BY page_id, link)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INT) AS n, link FROM d"""
)
def html_links(spark, sf_dir):
    p = t(spark, sf_dir, "pages")
    return p.select("page_id", F.posexplode(html.html_links(F.col("html"), F.col("url"), host="example.com")).alias("n", "link"))
