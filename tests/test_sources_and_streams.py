"""Readers, writers and streaming twins."""

import json

import pytest
from pyspark.sql import functions as F

from orgloom.sources import readers, schemas, writers
from orgloom.streaming import ledger


def test_tagged_places(spark, tmp_path):
    doc = {"elements": [{"type": "node", "id": 1, "lat": 1.0, "lon": 2.0, "tags": {"name": "N", "contact:phone": "", "phone": "5", "addr:street": "S", "facebook": "f"}}, {"type": "way", "id": 2, "center": {"lat": 3.0, "lon": 4.0}, "tags": {}}]}
    (tmp_path / "o.json").write_text(json.dumps(doc))
    got = {r.external_id: r for r in readers.tagged_places(spark, str(tmp_path / "o.json")).collect()}
    assert (got["node/1"].phone, got["node/1"].address_line1, got["node/1"].social) == ("5", "S", {"facebook": "f"})
    assert (got["way/2"].lat, got["way/2"].name, got["way/2"].address_line1) == (3.0, None, None)


def test_places_by_tags_and_area(spark, rows):
    cols = "type string, id long, lat double, lon double, center struct<lat:double,lon:double>, tags map<string,string>"
    tagged = {"amenity": "place_of_worship", "religion": "muslim"}
    e = spark.createDataFrame([("node", 1, 45.0, -75.0, None, tagged), ("way", 2, None, None, (44.0, -76.0), tagged), ("relation", 3, 45.0, -75.0, None, tagged), ("node", 4, 45.0, -75.0, None, {"amenity": "cafe"}), ("node", 5, 10.0, -75.0, None, tagged), ("node", 6, 45.0, -75.0, None, None)], cols)
    assert rows(readers.place_rows(e, tagged, (-141.0, 41.0, -52.0, 84.0)).select("external_id")) == [("node/1",), ("way/2",)]


def test_first_by_platform(spark):
    df = spark.createDataFrame([(["https://Facebook.com/a", "https://facebook.com/b", "https://instagram.com/c", "https://x.org"],), (None,)], "a array<string>")
    assert [r.m for r in df.select(readers.first_by_platform(F.col("a")).alias("m")).collect()] == [{"facebook": "https://Facebook.com/a", "instagram": "https://instagram.com/c"}, {}]


def test_kept_answers_are_replaced(spark, rows, tmp_path):
    cols = "query_hash string, results array<struct<title:string,url:string,content:string>>"
    writers.keep_answers(spark.createDataFrame([("a", [("t", "u1", "c")]), ("b", [("t", "u2", "c")])], cols), str(tmp_path / "one"))
    kept = spark.read.schema(cols).json(str(tmp_path / "one"))
    writers.keep_answers(spark.createDataFrame([("a", [("t", "u3", "c")])], cols), str(tmp_path / "two"), kept)
    assert rows(readers.kept_answers(spark, str(tmp_path / "two")).select("query_hash", "url")) == [("a", "u3"), ("b", "u2")]


def test_tables_are_made_once(spark, tmp_path):
    made = schemas.create_tables(spark, str(tmp_path), dry_run=True)
    assert made == list(schemas.TABLES) and not list(tmp_path.iterdir())
    assert schemas.create_tables(spark, str(tmp_path)) == made and schemas.create_tables(spark, str(tmp_path)) == []
    assert spark.read.parquet(str(tmp_path / "contacts.parquet")).count() == 0


def test_answers_and_release(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"query_hash": "h", "results": [{"title": "t", "url": "u", "content": "c"}]}\nnot json\n{"query_hash": "g", "results": 5}\n')
    assert [tuple(r) for r in readers.kept_answers(spark, str(tmp_path / "a.json")).collect()] == [("h", 0, "t", "u", "c")]
    (tmp_path / "r.json").write_text('{"latest": "2025-01"}')
    assert readers.latest_release(spark, str(tmp_path / "r.json")) == "2025-01"


def test_robots(spark, rows):
    urls = spark.createDataFrame([("https://a.ca/private/x",), ("https://a.ca/private/open",), ("https://b.ca/",)], "u string")
    rules = spark.createDataFrame([("https://a.ca", "/private", False), ("https://a.ca", "/private/open", True)], "origin string, prefix string, allow boolean")
    assert rows(readers.allowed_by_robots(urls, rules, "u")) == [("https://a.ca/private/open", True), ("https://a.ca/private/x", False), ("https://b.ca/", True)]


def test_open_places(spark, tmp_path):
    s = "id string, names struct<primary:string>, categories struct<primary:string,alternate:array<string>>, phones array<string>, emails array<string>, websites array<string>, addresses array<struct<freeform:string,locality:string,region:string,postcode:string,country:string>>, bbox struct<xmin:double,xmax:double,ymin:double,ymax:double>"
    df = spark.createDataFrame([("1", ("N",), ("x", ["mosque"]), [], None, ["w"], [("1 St", "T", "CA-ON", "M", "CA")], (-79.0, -78.0, 43.0, 44.0)), ("2", ("N",), ("mosque", None), None, None, None, [], (-79.0, -78.0, 43.0, 44.0))], s)
    df.write.parquet(str(tmp_path / "p"))
    got = readers.open_places(readers.table(spark, str(tmp_path / "p")), "mosque", (-141, 41, -52, 70), "CA").collect()
    assert [(r.external_id, r.province, r.phone, r.website, r.lng) for r in got] == [("1", "ON", None, "w", -78.5)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a</script>")], "i int, t string")
    writers.json_lines(df, str(tmp_path / "l"))
    writers.json_lines(df, str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).count() == 2
    page = writers.render("<p>__N__</p>__DATA__", df, {"__N__": "1"})
    assert page == '<p>1</p>[{"i":1,"t":"a<\\/script>"}]'
    with pytest.raises(ValueError):
        writers.render("", spark.range(3).toDF("i"), {}, most=2)


def stream_of(spark, tmp_path, df):
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))


def run(stream, name):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return stream.sparkSession.table(name)


def test_fresh_requests(spark, tmp_path):
    df = spark.createDataFrame([("a", "2025-01-01 00:00:00"), ("a", "2025-01-02 00:00:00"), ("b", "2025-01-01 00:00:00")], "k string, t string").select("k", F.col("t").cast("timestamp").alias("t"))
    got = run(ledger.fresh_requests(stream_of(spark, tmp_path, df), "k", "t", 90), "fresh")
    assert sorted(r.k for r in got.collect()) == ["a", "b"]


def test_spaced_stream(spark, tmp_path):
    df = spark.createDataFrame([("h", 0.0), ("h", 0.4), ("h", 5.0), ("g", 0.1)], "host string, at double")
    got = run(ledger.spaced_starts(stream_of(spark, tmp_path, df), "host", "at", 1.0), "spaced")
    assert sorted((r.host, r.at, r.start) for r in got.collect()) == [("g", 0.1, 0.1), ("h", 0.0, 0.0), ("h", 0.4, 1.0), ("h", 5.0, 5.0)]


def test_ticks_see_each_row_once(spark, tmp_path):
    seen = []
    df = spark.createDataFrame([(1,), (2,)], "i int")
    stream = stream_of(spark, tmp_path, df)
    tick = lambda: ledger.in_batches(stream, lambda b, n: seen.extend(r.i for r in b.collect()), str(tmp_path / "kept")).awaitTermination(120)
    tick()
    tick()
    spark.createDataFrame([(3,)], "i int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    tick()
    assert sorted(seen) == [1, 2, 3]
