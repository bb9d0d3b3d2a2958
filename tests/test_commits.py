"""Pages as a stream, tables committed at once, and collections in buckets: what failures and repeats leave."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestack.operators.retrieval import upserted
from lodestack.sources import buckets, commits, page_days
from lodestack.streaming.replay import drained


def saved(spark, path, *pages):
    page_days.save(spark.createDataFrame([(d, n, json.dumps(items)) for d, n, items in pages], "day string, page int, body string"), path)


def test_stopped_and_resumed_run_equals_one(spark, tmp_path):
    first = [("2024-01-01", 1, [{"id": "a"}, 5, {"id": "b"}]), ("2024-01-01", 2, {"items": [{"id": "c"}], "total": "3"})]
    more = [("2024-01-02", 1, [{"id": "a"}]), ("2024-01-01", 3, []), ("2024-01-02", 3, [{"id": "beyond a gap"}])]
    got = lambda df: sorted((r.day, r.page, r.place, r.id, r.total) for r in df.collect())
    path, out = f"{tmp_path}/in", f"{tmp_path}/out"
    assert got(drained(page_days.stream(spark, path), out)) == []
    for pages in (first, more):
        saved(spark, path, *pages)
        rows = drained(page_days.stream(spark, path, 1), out)
    want = [("2024-01-01", 1, 0, "a", None), ("2024-01-01", 1, 2, "b", None), ("2024-01-01", 2, 0, "c", 3), ("2024-01-02", 1, 0, "a", None)]
    assert got(rows) == want == got(drained(page_days.stream(spark, path), f"{tmp_path}/one"))
    assert got(drained(page_days.stream(spark, path), out)) == want  # nothing comes twice


def test_failed_batch_reads_the_same_pages_again(spark, tmp_path):
    path, seen = f"{tmp_path}/in", []
    saved(spark, path, ("d1", 1, [{"id": "a"}]), ("d1", 2, [{"id": "b"}]))

    def run(fails):
        def each(batch, epoch):
            if fails:
                raise RuntimeError("lost")
            seen.extend((epoch, r.id) for r in batch.collect())

        q = page_days.stream(spark, path).writeStream.foreachBatch(each).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        q.awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run(True)
    saved(spark, path, ("d2", 1, [{"id": "c"}]))
    run(False)
    assert sorted(seen) == [(0, "a"), (0, "b")]  # what failed first, without the page that came since
    run(False)
    assert sorted(seen) == [(0, "a"), (0, "b"), (1, "c")]
    with pytest.raises(Exception, match="no day to name"):
        saved(spark, path, ("../d", 1, []))


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    root, schemas = str(tmp_path), {"full": "id int, s string", "chunks": "id int", "records": "id int"}
    ids = spark.range(100).select(F.col("id").cast("int").alias("id"))
    full = ids.select("id", F.when(F.col("id") > 50, F.lit("ü")).alias("s"))
    counts = lambda: {k: v.count() for k, v in commits.committed(spark, root, **schemas).items()}
    assert counts() == {"full": 0, "chunks": 0, "records": 0}
    commits.commit(spark, root, "b1", full=full, chunks=ids, records=ids.limit(0))
    before = commits.committed(spark, root, **schemas)
    broken = ids.repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int").alias("id"))
    for batch in ("b2", "b1"):  # a new batch, and one that would replace
        with pytest.raises(Exception, match="lost"):
            commits.commit(spark, root, batch, full=full, chunks=ids, records=broken)
        assert counts() == {"full": 100, "chunks": 100, "records": 0}
    assert sorted(before["full"].collect()) == sorted((i, "ü" if i > 50 else None, "b1") for i in range(100))
    commits.commit(spark, root, "b1", full=full.limit(3), chunks=ids, records=ids)
    commits.commit(spark, root, "b0", chunks=ids)
    assert counts() == {"full": 3, "chunks": 200, "records": 100} and before["full"].count() == 100  # an older reading still stands
    assert commits.swept(root) >= 1 and counts() == {"full": 3, "chunks": 200, "records": 100} and commits.swept(root) == 0
    assert len(list(Path(root).glob("_files/*/*"))) == 2
    for bad in ("../b", ".b", ""):
        with pytest.raises(Exception, match="no batch to name"):
            commits.commit(spark, root, bad, full=full)


def test_upsert_writes_touched_buckets_only(spark, tmp_path):
    root, schema = f"{tmp_path}/c", "k string, v int, x array<float>"
    first = spark.createDataFrame([(f"k{i}", 1, [float(i)]) for i in range(500)] + [("", 1, None), (None, 1, None)], schema)
    assert len(buckets.upsert(spark, root, first, "k", "v", 32)) == 32
    second = spark.createDataFrame([("k7", 2, None), ("k7", 3, [7.5]), ("k8", 0, [0.0]), ("new", 1, [1.0])] + [("k9", 2, [9.0])] * 50, schema)
    old, files = buckets.collection(spark, root), set(Path(root).glob("v*/*/*.parquet"))
    touched = buckets.upsert(spark, root, second, "k", "v", 99)
    assert 1 <= len(touched) <= 4
    written = {p.parent.name for p in set(Path(root).glob("v*/*/*.parquet")) - files}
    assert written == {f"bucket={b}" for b in touched}
    rows = lambda df: sorted(map(repr, df.collect()))
    want = rows(upserted(first, second, "k", "v").select("k", "v", "x"))
    assert rows(buckets.collection(spark, root)) == want and old.count() == 500
    assert buckets.upsert(spark, root, first.limit(0), "k", "v") == [] and rows(buckets.collection(spark, root)) == want
    buckets.upsert(spark, root, second, "k", "v")  # again: nothing changes
    assert rows(buckets.collection(spark, root)) == want
    assert buckets.swept(spark, root) == 1 and rows(buckets.collection(spark, root)) == want
    with pytest.raises(ValueError):
        buckets.upsert(spark, root, second.withColumn("bucket", F.lit(1)), "k", "v")
    with pytest.raises(ValueError):
        buckets.upsert(spark, root, second, "v", "k")


def test_upserts_at_once(spark, tmp_path, monkeypatch):
    """One that read a state which another has replaced since fails, and leaves the other's rows."""
    root, row = f"{tmp_path}/c", lambda v: spark.createDataFrame([("a", v)], "k string, v int")
    buckets.upsert(spark, root, row(1), "k", "v", 4)
    seen = buckets.manifest(spark, root)
    buckets.upsert(spark, root, row(2), "k", "v")
    monkeypatch.setattr(buckets, "manifest", lambda *_: seen)
    with pytest.raises(RuntimeError, match="another upsert"):
        buckets.upsert(spark, root, row(3), "k", "v")
    monkeypatch.undo()
    assert [tuple(r) for r in buckets.collection(spark, root).collect()] == [("a", 2)]
