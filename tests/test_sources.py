from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from lodestack.operators import records
from lodestack.operators.retrieval import upserted
from lodestack.sources import binary, collections, jsonl, listing, paged
from lodestack.streaming import incremental


def test_jsonl_scans(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('﻿{"a": 1}\n\n  \n{"a": 2}\nnot json\n', encoding="utf-8")
    assert sorted(r.a for r in jsonl.scan(spark, str(p), "a int", strict=False).collect()) == [1, 2]
    with pytest.raises(Exception, match="not a JSON line"):
        jsonl.scan(spark, str(p), "a int").collect()
    z = tmp_path / "b.jsonl.gz"
    z.write_bytes(gzip.compress(b'{"a": 3}\n{"a": 4}\n'))
    assert sorted(r.a for r in jsonl.scan(spark, str(z), "a int").collect()) == [3, 4]
    assert [r.a for r in jsonl.scan(spark, str(z), "a int", limit=1).collect()] == [3]
    assert jsonl.scan(spark, str(tmp_path / "none*.jsonl"), "a int").collect() == []
    with pytest.raises(Exception, match=r"a\.jsonl:\d+: not a JSON line"):
        jsonl.scan(spark, str(p), "a int").collect()


def test_line_numbers(spark, tmp_path):
    for name, n in (("x", 3000), ("y", 7)):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"a": k, "pad": "p" * 50}) + "\n" for k in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = jsonl.numbered(spark, str(tmp_path)).collect()
        assert len(rows) == 3007 and all(json.loads(r.value)["a"] == r.line - 1 for r in rows)
        assert [r.a for r in jsonl.scan(spark, str(tmp_path), "a int, bad string", limit=5).collect()] == [0, 1, 2, 3, 4]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_snapshots_and_collections(spark, tmp_path):
    jsonl.snapshots(spark.createDataFrame([("a", "{}")], "id string, body string"), f"{tmp_path}/raw", "list", F.lit("2024-01-01"))
    assert [(r.id, r.kind, str(r.day)) for r in spark.read.parquet(f"{tmp_path}/raw").collect()] == [("a", "list", "2024-01-01")]
    root, schema = str(tmp_path), "id string, embedding array<float>"
    assert collections.create(spark, root, "c", schema).count() == 0
    spark.createDataFrame([("a", [1.0])], schema).write.mode("append").parquet(f"{root}/c")
    assert collections.create(spark, root, "c", schema).count() == 1
    assert spark.read.parquet(collections.backed_up(spark, root, "c", "20240101")).count() == 1
    assert collections.backed_up(spark, root, "c", "20240102") is None and collections.reset(spark, root, "c", schema).count() == 0


def test_jsonl_sinks(spark, tmp_path):
    d = spark.createDataFrame([(1, None)], "a int, b string")
    for _ in range(2):
        jsonl.append(d, str(tmp_path / "t"))
    assert jsonl.scan(spark, str(tmp_path / "t"), "a int, b string").count() == 2
    jsonl.overwrite(d, str(tmp_path / "t"))
    assert jsonl.scan(spark, str(tmp_path / "t"), "a int, b string").collect() == d.collect()
    assert json.loads(jsonl.report(d).first()[0]) == {"a": 1}


def test_published_batches_only(spark, tmp_path):
    d = spark.createDataFrame([(1,)], "a int")
    jsonl.publish(spark, str(tmp_path), "b1", chunks=d, full=d)
    jsonl.publish(spark, str(tmp_path), "b1", chunks=d, full=d)
    d.write.parquet(f"{tmp_path}/chunks/batch=b2")  # a batch that broke off
    assert jsonl.published(spark, str(tmp_path), "chunks").count() == 1


def test_paged_source(spark, tmp_path):
    for n, items in ((1, [{"id": "a"}, {"id": "b"}]), (2, [{"id": "c"}, 5])):
        (tmp_path / f"page_{n:05d}.json").write_text(json.dumps({"items": items}))
    paged.register(spark)
    got = spark.read.format("saved_pages").option("path", str(tmp_path)).load().orderBy("page", "place").collect()
    assert [r.id for r in got] == ["a", "b", "c"] and json.loads(got[0].item) == {"id": "a"}
    assert spark.read.format("saved_pages").option("path", str(tmp_path / "none")).load().count() == 0


def test_listing_rules(spark):
    rows = [(1, 0, "a", "2024-02-01", 14), (1, 1, "b", "2023-01-01", 14), (2, 0, "a", "2024-02-01", 14), (2, 1, " ", "", 14), (2, 2, "c", "2024-01-05", 14), (3, 0, "d", "2023-01-01", 14), (4, 0, "e", "2024-03-01", 14)]
    items = spark.createDataFrame([(p, n, i, d, t) for p, n, i, d, t in rows], "page int, place int, id string, item string, total int")
    ids = lambda **more: [r.id for r in paged.listed(items, **more).orderBy("page", "place").collect()]
    old = F.col("item") < "2024-01-01"
    assert ids() == ["a", "b"] and ids(least_size=5, limit=5) == ["a", "b", "c", "d"] and ids(limit=1) == ["a"]  # 14 items: one page of 50, three of 5
    big = items.withColumn("total", F.lit(None).cast("int"))
    listed = lambda **more: [r.id for r in paged.listed(big, **more).orderBy("page", "place").collect()]
    assert listed() == ["a", "b", "c", "d", "e"] and listed(old=old) == ["a", "c"] and listed(old=old, early_stop=False) == ["a", "c", "e"]


def test_pdf_of_documents(spark):
    docs = spark.createDataFrame([("a", ["u1", "u2", "u2", "u3"]), ("b", []), ("c", None), ("d", ["u1"]), ("e", ["gone"])], "k string, pdf_urls array<string>")
    texts = spark.createDataFrame([("u1", "", "pdf_too_large"), ("u2", "two", ""), ("u3", "three", "")], "path string, text string, issue string")
    got = lambda n: sorted(map(tuple, binary.pdf_of_documents(docs, texts, "k", most_urls=n).collect()))
    assert got(3)[0] == ("a", "two", "u2", "") and got(1)[0] == ("a", "", "u1", "pdf_too_large")
    assert got(1)[1:] == [("b", "", None, "no_pdf_url"), ("c", "", None, "no_pdf_url"), ("d", "", "u1", "pdf_too_large"), ("e", "", "gone", "pdf_extract_failed")]


def test_binary(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"x" * 10)
    (tmp_path / "b.pdf").write_bytes(b"y" * 100)
    files = binary.scan(spark, str(tmp_path), most_bytes=50)
    assert {r.path.rsplit("/", 1)[1]: r.content is None for r in files.collect()} == {"a.pdf": False, "b.pdf": True}
    assert {r.path.rsplit("/", 1)[1]: r.issue for r in binary.pdf_texts(files).collect()} == {"a.pdf": "pdf_extract_failed", "b.pdf": "pdf_too_large"}


def test_incremental(spark, tmp_path):
    d = spark.createDataFrame([(1, "2024-01-05"), (2, "04/01/2024"), (3, ""), (4, "2023-12-01")], "id int, day string")
    assert sorted(r.id for r in incremental.since(d, F.lit("2024-01-01"), ["day"]).collect()) == [1, 2, 3]
    assert incremental.checkpoint(d, ["day"]).first()[0] == "2024-01-05"
    assert incremental.checkpoint(d.limit(0), ["day"]).first()[0] is None
    stored = spark.createDataFrame([("1", "u1")], "id string, url string")
    batch = spark.createDataFrame([("1", "x"), ("2", "u1"), ("3", "u3"), ("3", "u3")], "id string, url string")
    assert [r.id for r in incremental.new_rows(batch, stored, [("id", "id"), ("url", "url")]).collect()] == ["3"]


def test_runs(spark):
    found = spark.createDataFrame([("1", "ok"), ("2", "no"), ("3", "bad"), ("3", "bad"), ("4", "ok"), ("5", "ok"), ("5", "ok")], "id string, s string")
    stored = spark.createDataFrame([("4",)], "id string")
    row = incremental.run_counts(found, stored, "id", F.col("s") != "no", F.col("s") == "bad").first()
    assert row.asDict() == {"discovered": 7, "duplicates": 3, "filtered": 1, "failed": 1, "saved": 2}
    rows, seen = incremental.counted(found, "run", bad=F.col("s") == "bad")
    assert rows.count() == 7 and seen.get == {"n": 7, "bad": 2}
    batch = spark.createDataFrame([("9", "b"), ("9", "a"), ("", "x"), ("", "x"), ("4", "z")], "id string, s string")
    assert sorted(map(tuple, incremental.backfilled(batch, stored, [("id", "id")]).collect())) == [("", "x"), ("", "x"), ("9", "a")]
    derived = incremental.repaired(found.distinct(), "id", {"clean": (stored, lambda d: d.select("id", F.upper("s").alias("t")))})
    assert sorted(r.id for r in derived["clean"].collect()) == ["1", "2", "3", "5"]
    days = spark.createDataFrame([("a", "01/02/2024"), ("b", ""), ("c", "2024-03-01"), ("d", "2024-03-01")], "id string, day string")
    assert [r.id for r in incremental.newest_first(days, "day", "id").collect()] == ["c", "d", "a", "b"]


def test_stream_into_versions(spark, tmp_path):
    state = {}

    def write(df, epoch):
        df.write.mode("overwrite").parquet(f"{tmp_path}/v{epoch}")
        state["path"] = f"{tmp_path}/v{epoch}"

    each = incremental.upsert_batches(lambda: spark.read.parquet(state["path"]) if state else None, write, "k", "v")
    for n, rows in enumerate(([("a", 1), ("b", 1)], [("b", 2)])):
        spark.createDataFrame(rows, "k string, v int").write.mode("append").parquet(f"{tmp_path}/in")
        q = spark.readStream.schema("k string, v int").parquet(f"{tmp_path}/in").writeStream.foreachBatch(each).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(state["path"]).collect())) == [("a", 1), ("b", 2)]
    assert upserted(spark.createDataFrame([], "k string, v int"), spark.createDataFrame([], "k string, v int"), "k", "v").count() == 0


def test_commands(spark, tmp_path, capsys):
    from lodestack.__main__ import main

    body = "A sentence that is long enough to be a chunk of its own."
    docs = spark.createDataFrame([("a", "1", "T", body, [], "Valid", 50, 2)], "canonical_doc_id string, crawl_time string, title string, content_clean string, pdf_urls array<string>, status string, quality_score int, chunk_count int")
    docs.write.parquet(f"{tmp_path}/docs")
    spark.createDataFrame([], "canonical_doc_id string, chunk_id string, text string, level string").write.parquet(f"{tmp_path}/chunks")
    main(["prepare", f"{tmp_path}/docs", f"{tmp_path}/chunks", f"{tmp_path}/out"], spark)
    assert json.loads(capsys.readouterr().out)["documents_from_content_clean"] == 1
    main(["current", f"{tmp_path}/out/chunks", f"{tmp_path}/current", "valid"], spark)
    main(["search", f"{tmp_path}/current", "long enough"], spark)
    assert json.loads(capsys.readouterr().out)["rank"] == 1
    main(["report", f"{tmp_path}/docs"], spark)
    assert json.loads(capsys.readouterr().out)["chunks"] == 2


def test_listing_survives_failed_pages(spark):
    a = lambda *urls: "".join(f'<a href="{u}">x</a>' for u in urls)
    rows = [(2, "http://x.org/l", a("/d?ItemID=1", "/d?ItemID=3", "/d?ItemID=4")), (1, "http://x.org/l", a("/d?ItemID=2", "/d?ItemID=1", "http://y.com/d?ItemID=9")), (3, "http://x.org/3", None), (4, "http://x.org/l", ""), (5, None, "<a href")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "number int, url string, html string, link int")
    got = lambda **more: [(r.page, r.place, r.link[-1]) for r in listing.listed_links(pages, host="x.org", needs="ItemID=", **more).orderBy("page", "place").collect()]
    assert got() == [(1, 0, "2"), (1, 1, "1"), (2, 1, "3"), (2, 2, "4")] and got(limit=3) == got()[:3] and got(limit=0) == []
    assert [tuple(r) for r in listing.failed_pages(pages).collect()] == [(3, "http://x.org/3")]
    assert listing.listed_links(pages.limit(0)).count() == 0


def test_details_fall_back_to_pages(spark):
    """An answer, one without files, an empty one, a failed one, none; and what has no page either."""
    said = '{"title":"T","documentRelatedList":[{"id":"9"}]}'
    answers = spark.createDataFrame([("a", said, '[{"fileName":"f.pdf","presignedUrl":"u"}]'), ("b", said, None), ("c", "{}", "[]"), ("d", None, None), ("f", None, None), (None, said, None)], "doc_id string, j string, f string")
    answers = answers.select("doc_id", F.from_json("j", records.DETAIL).alias("detail"), F.from_json("f", records.FILES).alias("files"))
    page = lambda k: (k, f"http://x?ItemID={k}", f"<h1>Page {k}</h1>")
    pages = spark.createDataFrame([page("a"), page("c"), page("d"), page("e"), ("f", "u", None), ("g", "u", None), (None, "u", "<h1>n</h1>")], "doc_id string, url string, html string")
    got = sorted((r.canonical_doc_id, r.origin, r.title, tuple(r.file_urls), len(r.related_documents)) for r in records.detail_or_page(answers, pages).collect())
    assert got == [("a", "api", "T", ("u",), 1), ("b", "api", "T", (), 1), ("c", "page", "Page c", (), 0), ("d", "page", "Page d", (), 0), ("e", "page", "Page e", (), 0)]
    assert sorted(r.doc_id for r in records.unanswered(answers, pages).collect()) == ["f", "g"]
    assert records.detail_or_page(answers.limit(0), pages.limit(0)).count() == 0
