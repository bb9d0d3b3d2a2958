"""Queries of sources, sinks, records and runs, on inputs derived from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import corpus, quality, records, topics
from ..sources import buckets, commits, jsonl, listing, page_days, paged
from ..sources.binary import pdf_of_documents
from ..sources.storage import shared_folder
from ..streaming import incremental
from ..streaming.replay import drained
from .queries import query, t


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT doc_id, lang, sha256(text) AS digest FROM documents")
def jsonl_round_trip(spark, sf_dir):
    """documents written as JSON lines, compressed, in two batches, and scanned strictly."""
    path, d = _folder(spark, "jsonl"), t(spark, sf_dir, "documents")
    half = F.col("n_chars") < 1000
    for batch in (d.where(half), d.where(~half)):
        jsonl.append(batch, path, "gzip")
    return jsonl.scan(spark, path, "doc_id long, text string, lang string").select("doc_id", "lang", F.sha2("text", 256).alias("digest"))


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def jsonl_first_rows(spark, sf_dir):
    """The first hundred lines of files that are in the order of ids."""
    path = _folder(spark, "jsonl")
    jsonl.overwrite(t(spark, sf_dir, "documents").select("doc_id", "lang").repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id"), path)
    return jsonl.scan(spark, path, "doc_id long, lang string", limit=100)


@query("SELECT doc_id, lang FROM documents WHERE n_chars >= 1000")
def jsonl_permissive(spark, sf_dir):
    """Lines of which those of short documents are broken; they are no rows."""
    path = _folder(spark, "jsonl")
    lines = F.to_json(F.struct("doc_id", "lang"))
    t(spark, sf_dir, "documents").select(F.when(F.col("n_chars") < 1000, F.substring(lines, 2, 1000)).otherwise(lines).alias("value")).write.text(path)
    return jsonl.scan(spark, path, "doc_id long, lang string", strict=False)


@query("SELECT doc_id, 'b2' AS batch, 'full' AS name FROM documents UNION ALL SELECT doc_id, 'b2', 'chunks' FROM labels")
def published_batches(spark, sf_dir):
    """Two tables of a batch that is published twice; a batch without its marker isn't seen."""
    root = _folder(spark, "published")
    full, chunks = t(spark, sf_dir, "documents").select("doc_id"), t(spark, sf_dir, "labels").select("doc_id")
    full.write.parquet(f"{root}/full/batch=b1")
    for _ in range(2):
        jsonl.publish(spark, root, "b2", full=full, chunks=chunks)
    read = [jsonl.published(spark, root, name).withColumn("name", F.lit(name)) for name in ("full", "chunks")]
    return read[0].unionByName(read[1]).select("doc_id", "batch", "name")


@query(
    """WITH i AS (SELECT o_orderkey AS k, CAST(o_orderkey // 50 + 1 AS INT) AS page, CAST(o_orderkey % 50 AS INT) AS place, CAST(o_custkey AS VARCHAR) AS id, o_orderstatus = 'F' AS old FROM orders)
SELECT min(struct_pack(page := page, place := place)).page AS page, min(struct_pack(page := page, place := place)).place AS place, id FROM i WHERE NOT old AND page * 50 < 900 + 50 GROUP BY id ORDER BY 1, 2 LIMIT 300"""
)
def paged_listing(spark, sf_dir):
    """Orders as saved pages of a list of 900 entries, by customer, without those of an old status."""
    path, o = _folder(spark, "pages"), t(spark, sf_dir, "orders")
    entry = F.struct((F.col("o_orderkey") % 50).alias("place"), F.col("o_custkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"))
    pages = o.groupBy((F.floor(F.col("o_orderkey") / 50) + 1).alias("page")).agg(F.sort_array(F.collect_list(entry)).alias("items"))  # fifty at most
    page_days.save(pages.select(F.lit("").alias("day"), "page", F.to_json(F.struct("items", F.lit(900).alias("total"))).alias("body")), path)
    paged.register(spark)
    items = spark.read.format("saved_pages").option("path", path).load()
    return paged.listed(items, limit=300, old=F.get_json_object("item", "$.status") == "F").select("page", "place", "id")


@query("SELECT 'd' || lpad(CAST(o_orderkey // 5000 AS VARCHAR), 5, '0') AS day, CAST(o_orderkey // 50 % 100 + 1 AS INT) AS page, CAST(o_orderkey % 50 AS INT) AS place, CAST(o_custkey AS VARCHAR) AS id, o_orderstatus AS status FROM orders")
def page_days_resumed(spark, sf_dir):
    """Orders as pages of fifty, a hundred of them a day: those of the first day are saved and streamed, then all others are, by
    a second run that goes on where the first one stopped."""
    path, out, o = _folder(spark, "days"), _folder(spark, "drained"), t(spark, sf_dir, "orders")
    entry = F.struct((F.col("o_orderkey") % 50).alias("place"), F.col("o_custkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"))
    day, page = F.format_string("d%05d", F.floor(F.col("o_orderkey") / 5000)), F.floor(F.col("o_orderkey") / 50) % 100 + 1
    pages = o.groupBy(day.alias("day"), page.alias("page")).agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("body"))  # fifty at most
    for part in (F.col("day") == "d00000", F.col("day") > "d00000"):
        page_days.save(pages.where(part), path)
        rows = drained(page_days.stream(spark, path), out)
    return rows.select("day", "page", "place", "id", F.get_json_object("item", "$.status").alias("status"))


@query("SELECT 'full' AS name, doc_id AS id, lang AS value FROM documents UNION ALL SELECT 'chunks', doc_id, CAST(quality AS VARCHAR) FROM labels UNION ALL SELECT 'pages', page_id, url FROM pages")
def three_tables_committed(spark, sf_dir):
    """Three tables committed as one batch, after a first try that had other rows, which the second replaces in all."""
    root = _folder(spark, "tables")
    full, chunks, pages = t(spark, sf_dir, "documents").select("doc_id", "lang"), t(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality")), t(spark, sf_dir, "pages").select("page_id", "url")
    commits.commit(spark, root, "b1", full=full.select("doc_id", F.lit("old").alias("lang")), chunks=chunks)
    commits.commit(spark, root, "b1", full=full, chunks=chunks, pages=pages)
    commits.swept(root)
    read = commits.committed(spark, root, full="doc_id long, lang string", chunks="doc_id long, quality string", pages="page_id long, url string")
    name = lambda k: read[k].drop("batch").toDF("id", "value").select(F.lit(k).alias("name"), "id", "value")
    return name("full").unionByName(name("chunks")).unionByName(name("pages"))


@query("SELECT doc_id, coalesce(l.quality, -1) AS quality, CASE WHEN l.doc_id IS NULL THEN 1 ELSE 2 END AS version FROM documents d LEFT JOIN labels l USING (doc_id)")
def bucketed_upsert(spark, sf_dir):
    """Documents as a collection in 16 buckets, into which their labels are merged as a second version."""
    root, d = _folder(spark, "buckets"), t(spark, sf_dir, "documents")
    buckets.upsert(spark, root, d.select("doc_id", F.lit(-1).alias("quality"), F.lit(1).alias("version")), "doc_id", "version", 16)
    buckets.upsert(spark, root, t(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(2).alias("version")), "doc_id", "version")
    buckets.swept(spark, root)
    return buckets.collection(spark, root)


@query(
    """WITH d AS (SELECT o_custkey, count(*) AS n, bool_and(o_orderstatus <> 'P') AS ok, bool_or(o_totalprice > 400000) AS bad, o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS known FROM orders GROUP BY o_custkey)
SELECT CAST(sum(n) AS BIGINT) AS discovered, CAST(sum(n - CASE WHEN known THEN 0 ELSE 1 END) AS BIGINT) AS duplicates, count(*) FILTER (NOT known AND NOT ok AND NOT bad) AS filtered,
  count(*) FILTER (NOT known AND bad) AS failed, count(*) FILTER (NOT known AND ok AND NOT bad) AS saved FROM d"""
)
def run_counts(spark, sf_dir):
    stored = t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return incremental.run_counts(t(spark, sf_dir, "orders"), stored, "o_custkey", F.col("o_orderstatus") != "P", F.col("o_totalprice") > 400000)


@query("SELECT o_custkey, max(o_orderkey) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY o_custkey")
def backfilled_rows(spark, sf_dir):
    """One row of each customer that isn't stored, whatever the order that rows come in."""
    stored = t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"))
    o = t(spark, sf_dir, "orders").select("o_custkey", F.format_string("%010d", -F.col("o_orderkey") + 10**9).alias("late"), F.col("o_orderkey").alias("n"))
    return incremental.backfilled(o, stored, [("o_custkey", "k")]).select("o_custkey", "n")


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'no_pdf_url' WHEN lang = 'de' THEN 'pdf_too_large' ELSE '' END AS issue, CASE WHEN lang IN ('en', 'de') THEN '' ELSE source END AS text FROM documents")
def pdf_choice(spark, sf_dir):
    """The first PDF with text of each document: English ones have none, German ones a large one only."""
    d = t(spark, sf_dir, "documents")
    url = lambda n: F.concat_ws("/", F.lit("u"), "doc_id", F.lit(n))
    docs = d.select("doc_id", F.when(F.col("lang") != "en", F.array(url("1"), url("1"), url("2"))).alias("pdf_urls"))
    rows = d.where("lang <> 'en'").select(F.explode(F.array(F.struct(url("1").alias("path"), F.lit("").alias("text"), F.lit("pdf_too_large").alias("issue")), F.struct(url("2").alias("path"), F.when(F.col("lang") != "de", F.col("source")).otherwise("").alias("text"), F.lit("").alias("issue")))).alias("r"))
    return pdf_of_documents(docs, rows.select("r.*"), "doc_id", most_urls=2).select("doc_id", "issue", "text")


@query(
    """WITH o AS (SELECT o_orderkey, o_orderdate AS d, o_orderkey % 7 AS c FROM orders)
SELECT o_orderkey, CASE WHEN c IN (0, 1, 2, 3) THEN strftime(d, '%Y-%m-%d') WHEN c = 4 THEN '' WHEN c = 5 THEN '2023-13-45' ELSE '' END AS day,
  CASE WHEN c = 0 THEN strftime(d, '%Y-%m-%dT00:00:00') WHEN c = 1 THEN strftime(d - INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') WHEN c = 2 THEN strftime(d, '%Y-%m-%dT00:00:00') WHEN c = 3 THEN strftime(d, '%Y-%m-%dT08:30:00') WHEN c = 5 THEN '2023-13-45T00:00:00' ELSE '' END AS moment,
  CASE WHEN c IN (1, 2, 3) THEN strftime(d, '%Y-%m-%d') ELSE '' END AS leading,
  CASE WHEN c = 1 THEN strftime(d - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M') WHEN c = 2 THEN strftime(d, '%Y-%m-%d 00:00') WHEN c = 3 THEN strftime(d, '%Y-%m-%d 08:30') END AS indexed FROM o"""
)
def dates_mixed(spark, sf_dir):
    """Dates of orders in seven spellings: slashed, with an offset, plain, in UTC, blank, impossible and none at all."""
    o = t(spark, sf_dir, "orders").withColumn("c", F.col("o_orderkey") % 7)
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    ways = [F.date_format("o_orderdate", "d/M/yyyy"), F.concat(day, F.lit("T00:00:00+07:00")), F.concat(F.lit(" "), day), F.concat(day, F.lit("T08:30:00Z")), F.lit(" "), F.lit("2023-13-45"), F.lit("soon")]
    o = o.withColumn("said", F.coalesce(*(F.when(F.col("c") == k, w) for k, w in enumerate(ways))))
    c = F.col("said")
    return o.select("o_orderkey", dates.date_iso(c).alias("day"), dates.datetime_iso(c).alias("moment"), dates.date_only(c).alias("leading"), F.date_format(dates.index_timestamp(c), "yyyy-MM-dd HH:mm").alias("indexed"))


@query("SELECT doc_id, lang || ' ' || source || ' ' || lang || ' ' || doc_id AS flat, [source, lang] AS parts FROM documents")
def flattened_values(spark, sf_dir):
    """A nested value as one text, and a list in one text as its items."""
    d = t(spark, sf_dir, "documents").withColumn("v", F.struct("lang", F.array(F.struct("source", F.lit(None).cast("string").alias("none")), F.struct(F.col("lang").alias("source"), F.lit("").alias("none"))).alias("items"), F.create_map(F.lit("k"), F.col("doc_id")).alias("m")))
    return d.select("doc_id", topics.flattened(F.col("v"), dict(d.dtypes)["v"]).alias("flat"), text.split_csv(F.concat("source", F.lit(" , , "), "lang", F.lit(","))).alias("parts"))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS number, lang AS kind, 'Agency ' || source AS agency, CASE WHEN source = 'web' THEN 'Title of the page' ELSE 'Title of the page' END AS title, '2024-01-15' AS issued,
  ['https://example.org/f/' || doc_id || '.pdf'] AS files, ['https://example.org/d?ItemID=' || doc_id] AS related, 'Text of ' || doc_id AS content FROM documents"""
)
def labelled_pages(spark, sf_dir):
    """Pages made from documents, read back: labels in a table and in a text, links to a file and to related documents."""
    d = t(spark, sf_dir, "documents")
    page = F.format_string(
        '<html><head><meta name="title" content="Title of the page"></head><body><table><tr><th>Số hiệu:</th><td>%d</td></tr><tr><td>Ngày ban hành<td>15/01/2024</table>'
        '<p>Loại văn bản: %s<p>Cơ quan ban hành: Agency %s</p><script>var x = "Số hiệu: 1";</script><div><b>Văn bản liên quan</b><a href="d?ItemID=%d">x</a></div>'
        '<a href="/f/%d.pdf">f</a><div class="content">Text of %d</div></body></html>',
        "doc_id", "lang", "source", "doc_id", "doc_id", "doc_id",
    )
    r = records.from_page(d.select(F.lit("https://example.org/p").alias("url"), page.alias("html")))
    return r.select(F.col("document_number").alias("number"), F.col("document_type").alias("kind"), F.col("issuing_agency").alias("agency"), "title", F.col("issued_date").alias("issued"), F.col("file_urls").alias("files"), F.col("related_documents").alias("related"), F.col("content_text").alias("content"))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS canonical_doc_id, 'P ' || source AS signer, 2 AS issues, lang || ', ' || source AS field, 'replaces' AS relation, 'https://x/' || (doc_id + 1) AS related,
  ['p' || doc_id] AS file_urls, '2024-01-14T17:00:00' AS issued_at FROM documents"""
)
def detail_parts(spark, sf_dir):
    """Signer, issues, field, relations and preferred files of API answers made from documents."""
    d = t(spark, sf_dir, "documents")
    person = lambda p: F.struct(p.alias("personName"))
    detail = F.struct(
        F.lit("2024-01-15T00:00:00+07:00").alias("issueDate"),
        F.array(person(F.concat(F.lit(" P "), "source")), person(F.lit(""))).alias("documentIssues"),
        F.array(F.struct(F.col("lang").alias("name")), F.struct(F.lit(" ").alias("name")), F.struct(F.col("source").alias("name"))).alias("documentMajors"),
        F.array(F.struct(F.lit("").alias("id"), (F.col("doc_id") + 1).cast("string").alias("targetDocumentId"), F.lit("12").alias("relatedType"))).alias("documentRelatedList"),
    )
    files = F.array(F.struct(F.lit("a.html").alias("fileName"), F.lit("h").alias("presignedUrl")), F.struct(F.lit("b.PDF").alias("fileName"), F.concat(F.lit("p"), "doc_id").alias("presignedUrl")))
    answers = d.select(F.col("doc_id").cast("string").alias("doc_id"), F.from_json(F.to_json(detail), records.DETAIL).alias("detail"), F.from_json(F.to_json(files), records.FILES).alias("files"))
    r = records.from_detail(answers, url_prefix="https://x/")
    related = F.get("related_documents", F.lit(0))
    return r.select("canonical_doc_id", "signer", F.col("issue_count").alias("issues"), "field", related["relation_type"].alias("relation"), related["url"].alias("related"), "file_urls", "issued_at")


@query("SELECT doc_id, trim(text) = '' OR lang = 'fr' AS lacking, CASE WHEN n_chars < 100 THEN 'pilot' WHEN n_chars < 0.95 * 1000 THEN 'incomplete' ELSE 'complete' END AS gate FROM documents")
def required_and_gate(spark, sf_dir):
    """Whether a required field is blank (French documents lose their source), and what a count says of completeness."""
    d = t(spark, sf_dir, "documents").withColumn("source", F.when(F.col("lang") == "fr", " ").otherwise(F.col("source")))
    return d.select("doc_id", quality.required_missing(["text", "source"]).alias("lacking"), corpus.count_gate(F.col("n_chars"), 1000, 100).alias("gate"))


@query(
    r"""WITH a AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, regexp_extract(url, '^https?:', 0) AS scheme, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
  generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS i FROM pages WHERE page_id % 7 <> 3),
u AS (SELECT page_id, i, CASE WHEN starts_with(href, '/') THEN scheme || '//' || host || href ELSE href END AS link FROM a WHERE href <> ''),
d AS (SELECT page_id, link, min(i) AS i FROM u WHERE suffix(regexp_extract(link, '^https?://([^/?#]*)', 1), 'example.com') GROUP BY page_id, link),
n AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INT) AS place, link FROM d),
w AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY page_id, place) AS r FROM n)
SELECT 'link' AS kind, page_id AS page, place, link FROM w WHERE r = 1 UNION ALL SELECT 'failed', page_id, NULL, url FROM pages WHERE page_id % 7 = 3"""
)
def html_listing(spark, sf_dir):
    """Links of all pages, each where it comes first; every seventh page fails and is reported."""
    p = t(spark, sf_dir, "pages").select("page_id", "url", F.when(F.col("page_id") % 7 != 3, F.col("html")).alias("html"))
    links = listing.listed_links(p, "page_id", host="example.com").select(F.lit("link").alias("kind"), "page", "place", "link")
    failed = listing.failed_pages(p, "page_id").select(F.lit("failed").alias("kind"), "page", F.lit(None).cast("int").alias("place"), F.col("url").alias("link"))
    return links.unionByName(failed)


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS canonical_doc_id, CASE lang WHEN 'en' THEN 'api' WHEN 'fr' THEN 'none' ELSE 'page' END AS origin, CASE lang WHEN 'en' THEN 'T ' || source WHEN 'fr' THEN NULL ELSE 'Page of ' || doc_id END AS title,
  CASE lang WHEN 'en' THEN 'A ' || source WHEN 'fr' THEN NULL ELSE 'B ' || source END AS agency, CASE WHEN lang = 'en' AND doc_id % 2 = 0 THEN ['f' || doc_id || '.pdf'] WHEN lang <> 'fr' THEN [] END AS files FROM documents"""
)
def details_with_fallback(spark, sf_dir):
    """Records of documents: English ones have answers (those of odd ids without their files), German ones an empty
    answer and a page, French ones neither, all others a page only."""
    d = t(spark, sf_dir, "documents").withColumn("key", F.col("doc_id").cast("string"))
    said = F.to_json(F.struct(F.concat(F.lit("T "), "source").alias("title"), F.concat(F.lit("A "), "source").alias("agencyName")))
    detail = F.from_json(F.when(F.col("lang") == "en", said).when(F.col("lang") == "de", F.lit("{}")), records.DETAIL)
    files = F.from_json(F.when(F.col("doc_id") % 2 == 0, F.format_string('[{"fileName":"f.pdf","presignedUrl":"f%d.pdf"}]', "doc_id")), records.FILES)
    answers = d.select("key", detail.alias("detail"), files.alias("files"))
    html = F.format_string("<html><body><h1>Page of %d</h1><p>Cơ quan ban hành: B %s</p></body></html>", "doc_id", "source")
    pages = d.select("key", F.format_string("https://example.org/d?ItemID=%d", "doc_id").alias("url"), F.when(F.col("lang") != "fr", html).alias("html"))
    r = records.detail_or_page(answers, pages, "key").select("canonical_doc_id", "origin", "title", F.col("issuing_agency").alias("agency"), F.col("file_urls").alias("files"))
    none = records.unanswered(answers, pages, "key").select(F.col("key").alias("canonical_doc_id"), F.lit("none").alias("origin"))
    return r.unionByName(none, allowMissingColumns=True)


@query("SELECT lang, count(*) AS rows, TRUE AS near FROM documents GROUP BY lang")
def merged_counts(spark, sf_dir):
    """Rows and distinct texts of each language by sketches of four batches, which are stored and merged; near: within three
    standard errors of the exact number."""
    path, d = _folder(spark, "counts"), t(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    corpus.counted(d.withColumn("batch", F.col("doc_id") % 4), ["batch", "lang"], "text").write.partitionBy("batch").parquet(path)
    exact = d.where(F.trim("text") != "").groupBy("lang").agg(F.count_distinct(F.sha2(F.trim("text"), 256)).alias("exact"))
    m = corpus.merged(spark.read.parquet(path), ["lang"]).join(exact, "lang", "left")
    return m.select("lang", "rows", (F.abs(F.col("documents") - F.coalesce("exact", F.lit(0))) <= 0.025 * F.coalesce("exact", F.lit(0))).alias("near"))
