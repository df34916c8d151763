"""Stores, the ingest plan, readers and the streaming runner."""

import json

from pyspark.sql import functions as F

from millrace import schema
from millrace.lexicon import Lexicon
from millrace.operators import store
from millrace.plans import pipeline
from millrace.sources import readers
from millrace.streaming import incremental

STORE = "source string, job_id string, title string, description string, posted_date string"


def landed(spark, rows):
    return spark.createDataFrame(rows, "job_id string, seq int, title string, description string, posted_date string")


def test_run_twice_adds_nothing(spark):
    known = spark.createDataFrame([("s", "k", "Medical Writer", "d", "2026-08-20")], STORE)
    ids = spark.createDataFrame([], "source string, job_id string")
    new = landed(spark, [
        ("k", 1, "Medical Writer", "d", "2026-08-25"), ("a", 2, "Medical Writer", "first", "2026-08-25"), ("a", 3, "Medical Writer", "second", "2026-08-25"),
        ("o", 4, "Medical Writer", "old", "2026-08-01"), ("u", 5, "Drug Safety Lead", "unknown day", ""), ("x", 6, "Baker", "bread", "2026-08-25"), ("v", 7, "Staff Nurse", "", "2026-08-25"),
    ])
    cfg = readers.SourceConfig("s")
    r = pipeline.run(new, known, ids, ids, Lexicon.roles(), cfg, "2026-09-01")
    assert {x.disposition: x.n for x in r.counters.collect()} == {"kept": 2, "known": 1, "excluded_old": 1, "out_of_scope": 2}
    assert sorted(x.job_id for x in r.store.collect()) == ["a", "k", "u"]
    assert r.store.where("job_id = 'a'").first().description == "first"
    assert [x.job_id for x in r.seen_old.collect()] == ["o"] and r.out_of_scope.where("vetoed_by <> ''").count() == 1
    assert r.export.columns == ["source", *schema.EXPORT_COLUMNS] and r.review.count() == 2
    again = pipeline.run(new, r.store, r.out_of_scope, r.seen_old, Lexicon.roles(), cfg, "2026-09-02")
    assert again.store.count() == 3 and "kept" not in {x.disposition for x in again.counters.collect()}


def test_unknown_dates_and_windows(spark):
    ids = spark.createDataFrame([], "source string, job_id string")
    empty = spark.createDataFrame([], STORE)
    new = landed(spark, [("a", 1, "Medical Writer", "", ""), ("b", 2, "Medical Writer", "", "2020-01-01")])
    keep = lambda **k: {x.job_id for x in pipeline.run(new, empty, ids, ids, Lexicon.roles(), readers.SourceConfig("s", **k), "2026-09-01").store.collect()}
    assert keep() == {"a"} and keep(unknown_dates="drop") == set() and keep(window_days=None) == {"a", "b"} and keep(window_days=None, unknown_dates="drop") == {"b"}


def test_reclassify(spark):
    df = spark.createDataFrame([("a", "Medical Writer", None, None), ("b", "Baker", None, None)], "job_id string, title string, skills string, description string")
    kept, dropped = pipeline.reclassify(df, Lexicon.roles())
    assert [r.job_id for r in kept.collect()] == ["a"] and [r.job_id for r in dropped.collect()] == ["b"]


def test_same_role(spark):
    rows = [(1, " Medical  Writer", "Acme", "Pune", "short", 5), (2, "medical writer", "ACME", "pune", "longer text", 1), (3, "Medical Writer", "Acme", "Delhi", "x", 1), (4, "medical writer", "acme", "pune", "longer tex2", 9)]
    df = spark.createDataFrame(rows, "seq int, title string, company string, city string, description string, created_ms long")
    assert sorted(r.seq for r in store.dedupe_same_role(df).collect()) == [3, 4]


def test_store_merges(spark):
    old = spark.createDataFrame([("s", "a", "1"), ("s", "b", "2")], "source string, job_id string, v string")
    new = spark.createDataFrame([("s", "b", "9", 1, "n"), ("s", "c", "3", 3, "n"), ("s", "c", "4", 2, "n")], "source string, job_id string, v string, seq int, extra string")
    assert sorted(tuple(r) for r in store.append_new(old, new).collect()) == [("s", "a", "1", ""), ("s", "b", "2", ""), ("s", "c", "4", "n")]
    assert {r.job_id: r.v for r in store.archive(old.withColumn("seq", F.lit(0)), new).collect()} == {"a": "1", "b": "9", "c": "3"}
    assert {r.job_id: r.v for r in store.overlay(old, spark.createDataFrame([("s", "a", " "), ("s", "b", "7")], old.schema), "v").collect()} == {"a": "1", "b": "7"}
    seen = store.touch(old.withColumn("last_seen", F.lit("x")), new, "today")
    assert {r.job_id: r.last_seen for r in seen.collect()} == {"a": "x", "b": "today"}
    day = spark.createDataFrame([("u", "t", "1")], "application_url string, title string, v string")
    assert [r.v for r in store.day_merge(day, day.withColumn("v", F.lit("2"))).collect()] == ["2"]


def test_capture_shapes(spark, tmp_path):
    card = {"jobId": "1", "title": "T", "createdDate": 5, "placeholders": [{"type": "salary", "label": "x"}]}
    (tmp_path / "a.json").write_text(json.dumps([card, card | {"jobId": "2"}]))
    (tmp_path / "b.json").write_text(json.dumps({"jobDetails": [card | {"jobId": "3"}]}))
    (tmp_path / "c.json").write_text(json.dumps([{"jobDetails": [card | {"jobId": "4"}]}, {"jobDetails": [card | {"jobId": "5"}]}]))
    (tmp_path / "d.json").write_text("{broken")
    assert sorted(r.jobId for r in readers.captures(spark, str(tmp_path)).collect()) == ["1", "2", "3", "4", "5"]


def test_text_sources(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>A</title><category>x</category><category>y</category><link>l</link></item></channel></rss>")
    assert [(r.title, r.category) for r in readers.rss(spark, str(tmp_path / "f.xml")).collect()] == [("A", ["x", "y"])]
    raw = spark.createDataFrame([("<loc>http://x/9</loc><loc>http://x/10</loc><loc>http://y/9</loc>",)], "value string")
    assert [tuple(r) for r in readers.sitemap(raw).collect()] == [("10", "http://x/10"), ("9", "http://y/9")]
    page = spark.createDataFrame([('<div class="card"><a href="/1">One <b>x</b></a></div><div class="card"><a href="/2">Two</a></div>',)], "html string")
    r = page.select(readers.anchors(F.col("html")).alias("a"), readers.cards(F.col("html"), 'class="card"', {"url": 'href="([^"]*)"'}).alias("c")).first()
    assert [(x.href, x.label) for x in r.a] == [("/1", "One x"), ("/2", "Two")] and [x.url for x in r.c] == ["/1", "/2"]


def test_files_and_stores(spark, tmp_path):
    for n in ("x-28-08-2026.json", "x-01-09-2026.json"):
        (tmp_path / n).write_text("{}")
    assert readers.newest_file(spark, str(tmp_path)).first().path.endswith("01-09-2026.json")
    s = schema.strings(("job_id", "text"))
    assert readers.csv_store(spark, str(tmp_path / "none.csv"), s).count() == 0
    df = spark.createDataFrame([("s", "1", 'a "q"\nb'), ("t", "NA", "")], "source string, job_id string, text string")
    for day in ("2026-09-01", "2026-09-01", "2026-09-02"):
        readers.write_export(df, str(tmp_path / "out"), day)
    back = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "out"))
    assert back.count() == 4 and back.where("job_id = '1'").first().text == 'a "q"\nb' and back.where("job_id = 'NA'").count() == 2


def test_stream_is_idempotent(spark, tmp_path):
    land, path = tmp_path / "land", str(tmp_path / "store")
    row = spark.createDataFrame([("s", "1", "a", 2), ("s", "1", "b", 1), ("s", "2", "c", 1)], "source string, job_id string, v string, seq int")
    row.coalesce(1).write.parquet(str(land))
    for _ in range(2):
        incremental.ingest(spark.readStream.schema(row.schema).parquet(str(land)), path, str(tmp_path / "cp")).awaitTermination()
        assert sorted((r.job_id, r.v) for r in spark.read.parquet(path).collect()) == [("1", "b"), ("2", "c")]
    row.withColumn("job_id", F.lit("1")).coalesce(1).write.mode("append").parquet(str(land))
    incremental.ingest(spark.readStream.schema(row.schema).parquet(str(land)), path, str(tmp_path / "cp2")).awaitTermination()
    assert spark.read.parquet(path).count() == 2


def test_live_windows_match_batch(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    live = spark.readStream.schema(e.schema).parquet("/root/testdata/sf0.001/event[s].parquet")
    q = incremental.windowed_counts(live, "ts", "event_type", "value").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("w").count() == incremental.windowed_counts(e, "ts", "event_type", "value").count()


def test_keep_last_and_archive_keep_rows_without_order(spark):
    """Null order columns wipe nothing: every row comes out whole."""
    rows = [("s", "a", "1", None), ("s", "a", "2", None), ("s", "b", "3", None), ("s", "b", "4", 1), ("s", None, "5", None)]
    df = spark.createDataFrame(rows, "source string, job_id string, v string, seq int")
    assert {tuple(r)[:3] for r in store.keep_last(df, store.KEY, "seq").collect()} == {("s", "a", "2"), ("s", "b", "4"), ("s", None, "5")}
    old = spark.createDataFrame([("s", "a", "1"), ("s", "c", "9")], "source string, job_id string, v string")
    new = spark.createDataFrame([("s", "a", "7", 1, "x"), ("s", "a", "8", 2, "y")], "source string, job_id string, v string, seq int, w string")
    got = {(r.job_id, r.v, r.w) for r in store.archive(old, new).collect()}
    assert got == {("a", "8", "y"), ("c", "9", None)}
    assert {(r.job_id, r.v) for r in store.archive(old, old.limit(0)).collect()} == {("a", "1"), ("c", "9")}
    feeds = spark.createDataFrame([("a", None, "x", 1), ("a", None, "y", 2)], "job_id string, seq int, feed string, n int")
    assert store.union_with_provenance(feeds).first().job_id == "a"
    assert store.first_known(df, F.col("job_id"), "seq", ("v",)).count() == 3


def test_limit_same_role_and_written_marks(spark, tmp_path):
    ids = spark.createDataFrame([], "source string, job_id string")
    empty = spark.createDataFrame([], STORE)
    rows = [(str(i), i, "Medical Writer", "d" * i, "2026-08-30", "Acme", "Pune", i) for i in range(1, 7)] + [("b", 9, "Baker", "x", "2026-08-30", "Acme", "Pune", 9)]
    new = spark.createDataFrame(rows, "job_id string, seq int, title string, description string, posted_date string, company string, city string, created_ms int")
    run = lambda **k: pipeline.run(new, empty, ids, ids, Lexicon.roles(), readers.SourceConfig("s"), "2026-09-01", **k)
    assert sorted(r.job_id for r in run(limit=4).store.collect()) == ["1", "2", "3", "4"]
    assert [r.job_id for r in run(limit=4, same_role=True).store.collect()] == ["4"]
    r = run(work=str(tmp_path / "marks"))
    assert r.store.count() == 6 and r.out_of_scope.count() == 1 and spark.read.parquet(str(tmp_path / "marks")).count() == 7
    text = pipeline.summary(r.counters, "2026-09-01").first().value
    assert json.loads(text) == {"as_of": "2026-09-01", "source": "s", "counts": {"kept": 6, "out_of_scope": 1}}
    old = pipeline.run(new, spark.createDataFrame([("s", "k", "x", "", "2026-12-01")], STORE), ids, ids, Lexicon.roles(), readers.SourceConfig("s", rolling_days=30), "2026-09-01")
    assert old.store.count() == 7


def test_tables_are_replaced_whole_and_locked(spark, tmp_path):
    import pytest

    path = str(tmp_path / "t")
    readers.replace_table(spark.range(5), path)
    readers.replace_table(spark.read.parquet(path).where("id > 2"), path)  # reads what it replaces
    assert spark.read.parquet(path).count() == 2 and not readers.exists(spark, path + ".old") and not readers.exists(spark, path + ".new-*")
    with readers.single_writer(spark, str(tmp_path / "lock")):
        with pytest.raises(RuntimeError):
            with readers.single_writer(spark, str(tmp_path / "lock")):
                pass
    with readers.single_writer(spark, str(tmp_path / "lock")):
        pass


def test_sheets_begin_with_a_mark(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x"y'), (None, "1,2")], "k string, v string")
    readers.write_sheets(df.coalesce(1), str(tmp_path / "s"))
    text = next((tmp_path / "s").glob("part-*")).read_text(encoding="utf-8")
    assert text == '\ufeff"k","v"\n"a","x""y"\n"","1,2"\n'
    got = readers.csv_rows(spark, str(tmp_path / "s"))
    assert got.columns == ["k", "v"] and got.count() == 2


def test_json_and_saved_pages_in_one_table(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"jobId": "1", "title": "T1"}]))
    (tmp_path / "p.html").write_text('<div class=c id="2">T2</div><div class=c id="3">T3</div>')
    fields = {"job_id": 'id="([^"]*)"', "title": ">([^<]*)<"}
    got = readers.card_files(spark, str(tmp_path / "*.json"), str(tmp_path / "*.html"), "<div class=c", fields, {"job_id": "jobId", "title": "title"})
    assert sorted((r.job_id, r.title) for r in got.collect()) == [("1", "T1"), ("2", "T2"), ("3", "T3")]


def test_received_files_are_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"source":"s","job_id":"a","seq":1}\n{broken\n{"source":"s","job_id":"b","seq":2}')
    stream = readers.landing(spark, str(tmp_path / "in"), "source string, job_id string, seq int")
    for _ in range(2):
        incremental.ingest(stream, str(tmp_path / "store"), str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(r.job_id for r in spark.read.parquet(str(tmp_path / "store")).collect()) == ["a", "b"]


def test_slices_and_pages_tell_what_is_missing(spark):
    df = spark.createDataFrame([(i, i) for i in range(10)], "job_id int, seq int")
    assert store.slices([(df, 0)], 10)[1] is False and store.slices([(df, 0), (df.where("seq < 5"), 1), (df.where("seq >= 5"), 1)], 10)[1] is True
    pages = spark.sql("select 0 as offset, 5 as total, array(named_struct('id', 1), named_struct('id', 2)) as items union all select 2, 0, array(named_struct('id', 2))")
    rows, seen = readers.paged(pages, "items", "total")
    assert sorted(r.id for r in rows.collect()) == [1, 2] and tuple(seen.first()) == (2, 5, False)


def test_absolute_links(spark):
    df = spark.createDataFrame([('<a href="/a?x=1&amp;y=2">A <b>b</b></a><a href="c.pdf">c</a><a href="https://z/q">z</a><a href="#t">t</a><a href="//w/v">w</a>', "https://h.org/d/e.html")], "h string, u string")
    got = df.select(readers.absolute_links(F.col("h"), F.col("u")).alias("l")).first().l
    assert [tuple(x) for x in got] == [("https://h.org/a?x=1&y=2", "A b"), ("https://h.org/d/c.pdf", "c"), ("https://z/q", "z"), ("https://w/v", "w")]
