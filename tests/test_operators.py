from __future__ import annotations

import random

from pyspark.sql import functions as F

from lodestack.functions import html
from lodestack.operators import assembly, chunking, corpus, embedding, quality, records, retrieval, structure, topics


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


def test_windows_cover_the_text(spark):
    lengths = [0, 39, 40, 1400, 1401, 2580, 2581, 5000]
    rng = random.Random(1)
    made = ["".join(rng.choice("abcdef") for _ in range(n)) for n in lengths]
    got = {}
    for r in chunking.fixed_windows(texts(spark, *made, None, "  "), "doc_id", "text").orderBy("doc_id", "chunk_no").collect():
        got.setdefault(r.doc_id, []).append(r.chunk)
    for i, t in enumerate(made):
        parts = got.get(i, [])
        assert all(len(p) <= 1400 for p in parts)
        assert "".join(p if k == 0 else p[220:] for k, p in enumerate(parts)) == t
    assert 8 not in got and 9 not in got
    assert [len(got[i]) for i in (3, 4, 5, 6)] == [1, 2, 2, 3]


def test_packer_by_hand():
    p = chunking.Packing(most=20, overlap=5, least=4)
    assert chunking.packed("", p) == [] and chunking.packed(None, p) == []
    assert chunking.packed("abc", p) == []  # shorter than the least
    assert chunking.packed("one two three", p) == ["one two three"]
    # paragraphs are packed, and a chunk begins with the end of the one before
    assert chunking.packed("aaaa aaaa\n\nbbbb bbbb\n\ncccc cccc", p) == ["aaaa aaaa\nbbbb bbbb", "bbbb\ncccc cccc"]
    # what is too short when the next doesn't fit is lost
    assert chunking.packed("ab\n\n" + "c" * 19, p) == ["c" * 19]
    # an oversized part is cut into windows, its tail within the overlap comes again, and no overlap follows it
    long = "".join(chr(97 + i) for i in range(23))
    assert chunking.packed(f"{long}\n\nzz zz", p) == [long[:20], long[15:], "zz zz"]
    # sentences where there are no paragraphs
    assert chunking.packed("First one here. Second one here. Third", p)[0] == "First one here."


def test_packed_chunks_keep_limits_and_unique_ids(spark):
    rng = random.Random(2)
    made = ["".join(rng.choice("ab. \n;") for _ in range(rng.randint(0, 9000))) for _ in range(30)]
    got = chunking.packed_chunks(texts(spark, *made).withColumn("extra", F.lit(1)), "doc_id", "text", "content_clean").collect()
    assert len({r.chunk_id for r in got}) == len(got) and all(len(r.text) <= 1400 and r.extra == 1 for r in got)
    assert all(r.chunk_id.startswith(f"{r.doc_id}:content_clean:00001:") for r in got)


LEGAL = """preamble is ignored
Điều 1. Phạm vi
first line
second line
1. clause one
goes on
a) point a
after the point
đ) no point
2. clause two
ĐIỀU 2
B) no clause before
1. again"""


def test_structure(spark):
    got = rows(structure.structured(texts(spark, LEGAL, None, ""), "doc_id", "text").select("level", "article_number", "article_title", "clause_number", "point_key", "content", "a", "c", "p"), "a", "c", "p")
    assert [g[:6] for g in got] == [
        ("article", "1", "Phạm vi", "", "", "first line\nsecond line"),
        ("clause", "1", "Phạm vi", "1", "", "clause one goes on after the point đ) no point"),
        ("point", "1", "Phạm vi", "1", "a", "point a"),
        ("clause", "1", "Phạm vi", "2", "", "clause two"),
        ("article", "2", "", "", "", "B) no clause before"),
        ("clause", "2", "", "1", "", "again"),
    ]


def test_short_chunks_take_no_number(spark):
    text = "Điều 1. T\n" + "x" * 90 + "\n1. short\n2. " + "y" * 90
    got = rows(structure.structured_chunks(texts(spark, text), "doc_id", "text"), "chunk_no")
    assert [(g[1], g[2]) for g in got] == [(1, "article"), (2, "clause")]
    assert got[1][6].startswith("Điều 1. T\nKhoản 2. yyy")


TOPICS = (topics.Topic("tax", "Thuế", ("thuế", "VAT", "vat")), topics.Topic("work", "Lao động", ("hợp đồng lao động",)))


def test_topics(spark):
    d = spark.createDataFrame([(1, "Về THUẾ và Hop dong lao dong", "private"), (2, "thuê nhà", "VAT"), (3, "private vatican", None)], "doc_id int, title string, body string")
    got = {r.doc_id: r for r in topics.match_topics(d, ["title", "body"], TOPICS).collect()}
    assert got[1].topic_labels == ["tax", "work"] and got[1].matched_keywords == ["thuế", "hợp đồng lao động"]
    assert got[2].topic_labels == ["tax"] and got[2].matched_fields == {"title": ["thuế"], "body": ["VAT"]}
    assert got[3].topic_labels == [] and got[3].matched_fields == {}
    assert topics.resolve(["lao động", "tax"], TOPICS) == ["work", "tax"]
    assert [r.doc_id for r in topics.any_keyword(d, ["body"], ["vat"]).collect()] == [2]


def test_unknown_topics_list_the_choices():
    try:
        topics.resolve(["none"], TOPICS)
    except ValueError as e:
        assert "tax, work" in str(e)
    else:
        raise AssertionError


def test_status(spark):
    d = spark.createDataFrame([("Còn hiệu lực",), ("CON  HIEU LUC",), ("Hết",), ("",), (None,)], "s string")
    assert [r[0] for r in d.select(topics.status_allowed(F.col("s"), ["còn hiệu lực"])).collect()] == [True, True, False, False, False]


def test_scores_reach_0_and_100(spark):
    c = [F.lit(x) for x in ("A title", "kind", "1/2", "2024-01-01", "agency", "http://x")]
    bare = [F.lit("  Văn bản  pháp luật "), *[F.lit(None).cast("string")] * 5]
    got = spark.range(1).select(quality.quality_score(*c, F.lit("x" * 1500)), quality.quality_score(*bare, F.lit("x" * 119)), quality.quality_flags(*bare[:4], F.lit(""))).first()
    assert tuple(got) == (100, 0, ["generic_title", "missing_document_type", "missing_document_number", "missing_issued_date", "short_content"])


def test_order_statistics_take_the_element_at_floor(spark):
    d = spark.createDataFrame([(v,) for v in (3, 1, 2, 0)], "v int")
    r = corpus.order_statistics(d, "v", {"p50": 0.5, "p99": 0.99, "all": 1.0}, 1, 2).first()
    assert (r.n, r.min, r.p50, r.p99, r["all"], r.max, r.under, r.over) == (4, 0, 2, 3, 3, 3, 1, 1)
    assert corpus.order_statistics(d.limit(0), "v", {"p50": 0.5}, 1, 2).first().n == 0


def test_order_statistics_over_ranges(spark):
    """Many distinct values, a hot one, and nulls; no window without a partition."""
    rng = __import__("random").Random(5)
    for values in ([rng.randrange(-10**6, 10**6) for _ in range(5000)] + [7] * 3000, [9] * 50, [1.5, -2.5, 0.25]):
        s, d = sorted(values), spark.createDataFrame([(v,) for v in [*values, None]], f"v {'double' if isinstance(values[0], float) else 'long'}")
        shares = {f"p{k}": k / 100 for k in (0, 1, 25, 50, 90, 99, 100)}
        r = corpus.order_statistics(d, "v", shares, 0, 9)
        got = r.first()
        assert [got[k] for k in shares] == [s[min(int(len(s) * q), len(s) - 1)] for q in shares.values()]
        assert (got.n, got.min, got.max, got.under, got.over) == (len(s), s[0], s[-1], sum(v < 0 for v in s), sum(v > 9 for v in s))
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(range" in plan and "windowspecdefinition(v" not in plan


def test_counts_of_batches_merge(spark):
    d = spark.createDataFrame([(b, g, k) for b in range(3) for g, k in (("x", "a"), ("x", "b "), ("x", f"own{b}"), ("y", " "), ("y", None), (None, "n"))], "batch int, g string, k string")
    counts = corpus.counted(d, ["batch", "g"], "k")
    assert {r.g: (r.rows, r.documents) for r in corpus.merged(counts, ["g"]).collect()} == {"x": (9, 5), "y": (6, 0), None: (3, 1)}
    assert corpus.merged(corpus.counted(d.limit(0), ["g"], "k"), ["g"]).count() == 0


def test_last_wins_and_blank_keys(spark):
    d = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (" ", 3, "z"), (None, 4, "w")], "k string, pos int, v string")
    assert rows(corpus.last_wins(d, ["k"], ["pos"]), "k") == [("a", 2, "y")]


def test_anti_join_by_either_key(spark):
    d = spark.createDataFrame([("1", "u1"), ("2", "u2"), ("", ""), (None, None)], "id string, url string")
    known = spark.createDataFrame([("1", "z"), ("9", "u2"), ("", ""), (None, None)], "id string, url string")
    assert sorted(map(tuple, corpus.without_known(d, known, [("id", "id"), ("url", "url")]).collect()), key=str) == [("", ""), (None, None)]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, x int, v int")
    new = spark.createDataFrame([("b", 2, 2), ("c", 2, 2)], "k string, x int, v int")
    once = retrieval.upserted(old, new, "k", "v")
    assert rows(once, "k") == rows(retrieval.upserted(once, new, "k", "v"), "k") == [("a", 1, 1), ("b", 2, 2), ("c", 2, 2)]


def test_lexical_scores_and_ties(spark):
    chunks = spark.createDataFrame([(1, "Red fox", "the red fox ran"), (2, "", "red fox"), (3, "", "red fox"), (4, "", "nothing")], "c int, title string, body string")
    q = spark.createDataFrame([(7, "Red FOX")], "q int, text string")
    got = rows(retrieval.lexical_topk(chunks, q, "c", "title", "body", "q", "text", 3), "rank")
    assert got == [(7, 1, 1, 50 + 8 + 8 + 2), (7, 2, 2, 60), (7, 3, 3, 60)]


def test_vectors_in_blocks(spark):
    v = spark.createDataFrame([(i, [float(i == 0), float(i == 1), 0.6 * (i == 2) + 0.0]) for i in range(3)], "id int, e array<float>")
    q = v.select(F.col("id").alias("q"), F.col("e").alias("x"))
    old, retrieval.BLOCK = retrieval.BLOCK, 1
    try:
        assert len(retrieval.blocks(q, 1)) == 3
    finally:
        retrieval.BLOCK = old
    assert rows(retrieval.vector_topk(v, q, "id", "e", "q", "x", 1), "q") == [(0, 1, 0, 1.0, 0.0), (1, 1, 1, 1.0, 0.0), (2, 1, 2, 0.36, 0.64)]


def test_metadata_and_citations(spark):
    d = spark.createDataFrame([(1, ["a", 'b"'], None)], "n int, l array<string>, s string")
    assert tuple(retrieval.flat_metadata(d, ["n", "l", "s"]).first()) == (1, '["a", "b\\""]', "")
    got = spark.range(1).select(retrieval.citation(F.lit("1"), F.lit(""), F.lit("a")), retrieval.citation(F.lit(""), F.lit(None), F.lit(""))).first()
    assert tuple(got) == ("Điều 1, Điểm a", "unknown")


PAGE = """<html><head><meta property="og:title" content=" "><title>no</title><script>var x="</p><p>no";</script></head><body>
<nav><a href="/nav">n</a></nav><h1> Head &amp; tail </h1><table><tr><td>Số hiệu:<td>12/2020/TT-BTC<tr><td>Cơ quan ban hành<td>Bộ</table>
<p>Loại văn bản: Thông tư<p>two <b>bold<br>text</b><ul><li>Văn bản liên quan <a href="x?ItemID=5">r</a><a href="x?ItemID=5">r</a></ul>
<div class="content"><p>inside</p></div><a href="/f/a.PDF">f</a><a href="http://[bad">b</a></body>"""


def test_html(spark):
    d = spark.createDataFrame([("http://h.example.org/p/q", PAGE), ("u", None)], "url string, html string")
    h, u = F.col("html"), F.col("url")
    r, empty = d.select(html.html_title(h), html.html_content(h), html.html_blocks(h), html.html_file_links(h, u), html.html_related_links(h, u), html.html_links(h, u, "example.org", "^/p/", "ItemID="), html.html_pairs(h)).collect()
    assert r[0] == "Head & tail" and r[1] == "inside"
    assert r[2][:3] == ["Loại văn bản: Thông tư", "two bold text", "inside"] and r[2][-1] == "Head & tail"
    assert r[3] == ["http://h.example.org/f/a.PDF"] and r[4] == r[5] == ["http://h.example.org/p/x?ItemID=5"]
    assert r[6]["so hieu"] == ["12/2020/TT-BTC"] and r[6]["loai van ban"] == ["Thông tư"]
    assert tuple(empty) == ("", "", [], [], [], [], {})
    rec = records.from_page(d).collect()[0]
    assert (rec.document_number, rec.issuing_agency, rec.document_type) == ("12/2020/TT-BTC", "Bộ", "Thông tư")


def test_detail_records(spark):
    detail = '{"title":" T ","docType":{"name":"Luật"},"issueDate":"2024-01-01T00:00:00+07:00","documentIssues":[{"personName":" P "},{},{},{}],"documentMajors":[{"name":"m"},{"name":"n"}],"documentRelatedList":[{"id":"","targetDocumentId":"7","relatedType":"12"},{}],"documentContent":"Trang chủ\\nbody"}'
    files = '[{"fileName":"a.html","presignedUrl":"h"},{"fileName":"b.PDF","presignedUrl":"p"},{"fileName":"c"}]'
    d = spark.createDataFrame([("42", detail, files)], "doc_id string, d string, f string")
    d = d.select("doc_id", F.from_json("d", records.DETAIL).alias("detail"), F.from_json("f", records.FILES).alias("files"))
    r = records.from_detail(d, url_prefix="https://x/").first()
    assert (r.title, r.document_type, r.signer, r.issue_count, len(r.issues), r.field) == ("T", "Luật", "P", 4, 3, "m, n")
    assert (r.issued_date, r.issued_at) == ("2024-01-01", "2023-12-31T17:00:00")
    assert r.file_urls == ["p"] and [x.asDict() for x in r.related_documents] == [{"id": "7", "url": "https://x/7", "relation_type": "replaces", "title": ""}]
    assert r.content_text == "body"
    ready = records.rag_ready(records.from_detail(d, url_prefix="https://x/")).first()
    assert ready.quality_flags == ["missing_document_number", "short_content"]


def test_header(spark):
    content = "ỦY BAN NHÂN DÂN TỈNH\nCỘNG HÒA XÃ HỘI CHỦ NGHĨA VIỆT NAM\nSố: 12/2020/QĐ-UBND\nHà Nội, ngày 1 tháng 2 năm 2020\nCăn cứ Luật A;\nTheo đề nghị của B;"
    got = spark.range(1).select(*(c.alias(k) for k, c in records.header_fields(F.lit(content)).items())).first().asDict()
    assert got["header_document_code"] == "Số: 12/2020/QĐ-UBND" and got["header_issuing_body"] == "ỦY BAN NHÂN DÂN TỈNH"
    assert got["header_place_date"] == "Hà Nội, ngày 1 tháng 2 năm 2020" and len(got["header_legal_bases"]) == 2


def test_clean_corpus(spark):
    body = "A sentence that is long enough to be a chunk of its own."
    docs = spark.createDataFrame(
        [("a", 1, "old", body, ["u"]), ("a", 2, "new", body, ["u"]), ("b", 3, "t", body, []), ("c", 4, "t", " ", ["p", "q"]), ("d", 5, "t", None, ["p"]), ("e", 6, "t", "", []), ("f", 7, "t", "tiny", []), (" ", 8, "t", body, [])],
        "canonical_doc_id string, pos int, title string, content_clean string, pdf_urls array<string>",
    )
    chunks = spark.createDataFrame(
        [("a", 2, "second " + body, "clause", "1"), ("a", 1, "first " + body, "article", "1"), ("zz", 1, body, "article", ""), ("b", 1, "short", None, "")],
        "canonical_doc_id string, chunk_no int, text string, level string, article_number string",
    )
    pdfs = spark.createDataFrame([("c", "pdf " + body, "p", ""), ("d", "", "p", "pdf_too_large")], "canonical_doc_id string, text string, pdf_url string, issue string")
    out, issues = assembly.clean_corpus(docs, chunks, "canonical_doc_id", "pos", "chunk_no", pdfs)
    got = [(r.chunk_id, r.title, r.source_level, r.text.split()[0], r.pdf_url, r.article_number) for r in out.orderBy("chunk_id").collect()]
    assert got == [
        ("a:crawler_chunk:00001:001", "new", "article", "first", None, "1"),
        ("a:crawler_chunk:00002:001", "new", "clause", "second", None, "1"),
        ("b:content_clean:00001:001", "t", "document", "A", None, ""),
        ("c:pdf_text:00001:001", "t", "document", "pdf", "p", ""),
    ]
    assert sorted((r.canonical_doc_id, r.issue, r.pdf_url_count, r.pdf_extract_issue) for r in issues.collect()) == [("d", "needs_ocr", 1, "pdf_too_large"), ("e", "missing_text", 0, "")]
    without = assembly.clean_corpus(docs, chunks, "canonical_doc_id", "pos", "chunk_no")[1]
    assert sorted((r.canonical_doc_id, r.pdf_extract_issue) for r in without.collect()) == [("c", "pdf_extract_not_attempted"), ("d", "pdf_extract_not_attempted"), ("e", "")]
    stats = {r.name: r.n for r in assembly.statistics(out, issues, "canonical_doc_id").collect()}
    assert stats["documents_from_crawler_chunk"] == 1 and stats["missing_text"] == 1 and stats["chunks"] == 4
    current = assembly.current_corpus(out.withColumn("status", F.when(F.col("canonical_doc_id") == "a", "Còn hiệu lực")), "status", ["con hieu luc"])
    assert {r.retrieval_scope for r in current.collect()} == {"current"} and current.count() == 2


def test_low_content_fallback(spark):
    c = [F.lit(x) for x in ("short", "<p>x</p>", "a longer text", "")]
    got = spark.range(1).select(assembly.with_fallback(c[0], c[1], c[2]), assembly.with_fallback(c[0], c[1], c[3]), assembly.with_fallback(F.lit("y" * 900), c[1], c[2])).first()
    assert tuple(got) == ("a longer text", "short", "y" * 900)


def test_embedding(spark):
    d = spark.createDataFrame([(1, "T", "red fox runs", ["a"]), (2, None, "Red fox, runs!", None), (3, "", None, []), (4, "", "blue whale", [])], "c int, title string, body string, tags array<string>")
    r = {x.id: x for x in embedding.collection_rows(d, "c", "title", "body", ["title", "tags"]).collect()}
    assert (r["1"].tags, r["2"].tags, r["2"].title) == ('["a"]', "", "")
    assert abs(sum(x * x for x in r["1"].embedding) - 1) < 1e-5 and len(r["4"].embedding) == 64
    e = [x[0] for x in d.orderBy("c").select(embedding.embed(F.col("body"), batch=3)).collect()]
    assert e[0] == e[1] and e[2] == [0.0] * 64 and e[0] != e[3]


def test_required_fields_and_gates(spark):
    d = spark.createDataFrame([("a", "t"), (" ", "t"), (None, "t"), ("a", " ")], "id string, text string")
    assert [r[0] for r in d.select(quality.required_missing(["id", "text"])).collect()] == [False, True, True, True]
    n = spark.createDataFrame([(99_999,), (570_000,), (590_000,)], "n long")
    assert [r[0] for r in n.select(corpus.count_gate(F.col("n"), 607_679)).collect()] == ["pilot", "incomplete", "complete"]


def test_summary_of_nothing_and_of_nulls(spark):
    d = spark.createDataFrame([(None, None, None, None), ("text", 39, ["u"], 2), (" ", 40, [], 0)], "content string, score int, pdf array<string>, n int")
    r = quality.summary(d, "content", "score", {"pdf": "pdf"}, "n").first()
    assert (r.records, r.with_content, r.with_pdf, r.with_chunks, r.chunks, r.average_score, r.low_score) == (3, 1, 1, 1, 2, 39.5, 1)
    assert quality.summary(d.limit(0), "content", "score", {}, None).first().average_score == 0.0
    assert rows(quality.warnings(d.withColumn("k", F.col("n")), "k", "content"), "k") == [(None, "empty_content", 0), (0, "empty_content", 0), (2, "short_content", 4)]


def test_status_counts_with_blanks(spark):
    d = spark.createDataFrame([("Valid",), (" valid ",), ("",), (None,), ("gone",)], "status string")
    got = rows(corpus.status_counts(d, "status", topics.status_allowed(F.col("status"), ["valid"])), "status")
    assert got == [("<missing>", 2, 0, 2), ("Valid", 1, 1, 0), ("gone", 1, 0, 1), ("valid", 1, 1, 0)]


def test_repair_lists_what_is_missing(spark):
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "id int")
    got = rows(corpus.missing_outputs(ids(1, 2, 3, 3), "id", full=ids(1, 2, 2), chunks=ids(1)), "id")
    assert got == [(2, False, True), (3, True, True)]
    assert rows(corpus.zero_filled_counts(ids(1, 2), ids(2, 2, 3), "id"), "id") == [(1, 0), (2, 2)]


def test_long_texts_are_parsed_block_by_block(spark, monkeypatch):
    from lodestack.operators import structure

    said = [x for k in range(1, 40) for x in (f"Điều {k}. title {k}", "a line", f"{k}. clause", "more", "a) point", "rest")]
    d = spark.createDataFrame([(1, "\n".join(["before", *said])), (2, ""), (3, None)], "doc_id int, text string")
    whole = [tuple(r) for r in structure.structured(d, "doc_id", "text").collect()]
    monkeypatch.setattr(structure, "FOLD", 7)
    assert [tuple(r) for r in structure.structured(d, "doc_id", "text").collect()] == whole and len(whole) == 39 * 3


def test_result_rows_cite(spark):
    chunks = spark.createDataFrame([("c1", "T", "5", None, "a", ["x", "y"], "body"), ("c2", None, "", "", None, [], None)], "chunk_id string, title string, article_number string, clause_number string, point_key string, topic_labels array<string>, text string")
    top = spark.createDataFrame([(1, 1, "c1", 0.5), (1, 2, "c2", 0.25), (1, 3, "gone", 0.1)], "query int, rank int, chunk_id string, score double")
    r = retrieval.result_rows(top, chunks, "chunk_id").orderBy("rank")
    assert r.columns[:4] == top.columns and set(retrieval.RESULT_FIELDS) < set(r.columns)
    assert [(x.rank, x.title, x.status, x.topic_labels, x.citation, x.text) for x in r.collect()] == [(1, "T", "", '["x", "y"]', "Điều 5, Điểm a", "body"), (2, "", "", "[]", "unknown", ""), (3, "", "", "", "unknown", "")]
    assert retrieval.result_rows(top.limit(0), chunks, "chunk_id").count() == 0


def test_warnings_with_lines_and_first_keys(spark):
    d = spark.createDataFrame([("b", " ", 1), ("a", "x" * 199, 2), ("b", "x" * 200, 3), ("c", None, 4), (None, "y", 5), (" ", "y", 6)], "k string, text string, n int")
    assert rows(quality.warnings(d, "k", "text", line="n"), "line")[:2] == [("b", "empty_content", 0, 1), ("a", "short_content", 199, 2)]
    assert sorted(r.n for r in corpus.first_keys(d, "k", "n", 2).collect()) == [1, 2, 3] and corpus.first_keys(d, "k", "n", 0).count() == 0
    assert sorted(r.n for r in corpus.first_keys(d, "k", "n", 9).collect()) == [1, 2, 3, 4]


def test_texts_are_packed_by_bytes_not_rows():
    import pyarrow as pa

    texts = pa.array([None, "", "é" * 500_000, *["w" * 1000] * 5000, "x" * (chunking.BATCH_BYTES + 1), None, "y"])
    slices = list(chunking._slices(texts.slice(1)))
    assert pa.concat_arrays(slices).equals(texts.slice(1)) and len(slices) > 3
    assert all(len(s) == 1 or sum(len((t.as_py() or "").encode()) for t in s) <= chunking.BATCH_BYTES for s in slices)
    assert list(chunking._slices(pa.array([], pa.string()))) == []
