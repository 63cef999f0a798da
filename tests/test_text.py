import json

import pyarrow as pa
from pyspark.sql import functions as F

from trendlens import relational
from trendlens.functions import text as tx
from trendlens.operators import cleaning, html, ingest, sentiment
from trendlens.plans import queries_models
from trendlens.sources import readers, writers


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first().y


def test_scrub_order_and_unicode_space(spark):
    assert one(spark, "<p>Hi   there</p> see http://a.b/c?d now www.x.y end", tx.scrub) == "Hi there see now end"


def test_word_count_edges(spark):
    assert [one(spark, v, tx.word_count) for v in (None, "", "  ", " a  b ")] == [0, 0, 0, 2]


def test_paywalled_feed_is_rejected_whole(spark):
    rows = [(i, f"t{i}", "d", tx.PAYWALL_MARKER, "s", "2025-01-01 00:00:00") for i in range(20)]
    df = spark.createDataFrame(rows, "article_id long, title string, description string, content string, source string, publishedAt string")
    report = {r.reason: r.n for r in cleaning.rejection_report(df).collect()}
    assert report == {"paid": 20}
    assert cleaning.clean_articles(df, detect_spread=False).count() == 0


def test_exactly_hundred_words_kept_and_last_duplicate_wins(spark):
    long, short = " ".join(["w"] * 100), " ".join(["w"] * 99)
    rows = [(1, "a", long, "s", "2025"), (2, "a", long + " x", "s", "2025"), (3, "b", short, "s", "2025")]
    df = spark.createDataFrame(rows, "article_id long, title string, text string, source string, publishedAt string")
    kept = cleaning.clean_articles(df, detect_spread=False).collect()
    assert [r.article_id for r in kept] == [2]
    report = {r.reason: r.n for r in cleaning.rejection_report(df).collect()}
    assert report == {"short": 1, "exact_duplicate": 1, "new": 1}


def test_null_urls_pass_the_seen_filter(spark):
    batch = spark.createDataFrame([(1, "u1"), (2, None), (3, "u3")], "pos long, url string")
    seen = spark.createDataFrame([("u1",), (None,)], "url string")
    assert sorted(r.pos for r in ingest.new_by_url(batch, seen, 2).collect()) == [2]
    assert sorted(r.pos for r in ingest.new_by_url(batch, seen, None).collect()) == [2, 3]


def test_raw_reader_skips_unreadable_file(spark, tmp_path):
    item = {"title": "t", "description": None, "source": "s", "publishedAt": "2025-01-01 00:00:00", "content": "c", "url": "u"}
    (tmp_path / "news_1.json").write_text(json.dumps([item, {**item, "url": "v"}]))
    (tmp_path / "news_2.json").write_text("{not json")
    glob = str(tmp_path / "news_*.json")
    assert sorted(r.url for r in readers.read_raw_articles(spark, glob).collect()) == ["u", "v"]
    assert readers.unreadable_files(spark, glob).count() == 1
    (tmp_path / "scraped.json").write_text(json.dumps({"articles": [{"title": "t", "source": {"name": "n"}}, {"title": "q", "source": "m"}]}))
    got = readers.read_scraped_articles(spark, str(tmp_path / "scraped.json")).collect()
    assert sorted(r.source for r in got) == ["m", "n"]


def test_refresh_rebuilds_only_when_stale(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(3).write.parquet(src)
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    assert writers.refresh_daily(spark, [src], out, build).count() == 5
    writers.refresh_daily(spark, [src], out, build)
    assert len(calls) == 1
    writers.refresh_daily(spark, [src], out, build, max_age_hours=0)
    assert len(calls) == 2


def p(n):
    return "<p>" + " ".join(["w"] * n) + "</p>"


def test_main_text_rules():
    assert html.main_text(f"<nav>{p(60)}</nav><article>{p(51)}</article>{p(9)}").split() == ["w"] * 51
    assert len(html.main_text(f"<article>{p(20)}</article>{p(40)}").split()) == 60
    assert len(html.main_text(f"<article>{p(50)}</article>{p(40)}").split()) == 50
    assert len(html.main_text(f"<article>{p(10)}</article><main>{p(55)}</main>").split()) == 55
    assert html.main_text("<p>a &amp; b<script>x()</script></p>") == "a & b"
    assert html.main_text(None) == ""


def test_texts_are_python_objects_a_few_megabytes_at_a_time(spark):
    rows = spark.range(0, 60, 1, 1).select(F.col("id").alias("article_id"), F.repeat(F.lit("word "), 80_000).alias("text"))

    def by_batch(texts):
        import pandas as pd

        return pd.DataFrame({"label": ["positive"] * len(texts), "score": [texts.str.len().sum() / 1e9] * len(texts)})

    got = sentiment.score_with_callable(rows, by_batch).agg(F.max("sentiment_confidence").alias("m"), F.count("*").alias("n"), F.min("sentiment").alias("s")).first()
    assert (got.n, got.s) == (60, "positive") and got.m * 1e9 <= 5e6  # all 24 MB came as one batch
    pages = rows.select(F.concat(F.lit("<article><p>"), "text", F.lit("</p></article>")).alias("html"))
    assert html.extract_main_text(pages).select(F.length("main_text").alias("n")).distinct().collect()[0].n == 399_999
    sizes = [b.num_rows for b in relational.pieces(iter([pa.RecordBatch.from_pydict({"x": ["y" * (3 << 20)] * 5})]))]
    assert sizes == [1] * 5


def test_latest_files_of_a_feed_are_one_per_task(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    pages.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries_models.src3(spark, str(tmp_path))
    assert got.first()["rows"] == pages.count()
    assert len(got.inputFiles()) == 3  # one task wrote and read the whole feed
    pages.limit(0).write.parquet(f"{tmp_path}/none/pages.parquet")
    assert queries_models.src3(spark, f"{tmp_path}/none").first()["rows"] == 0


def test_white_space_is_collapsed_and_words_are_counted_in_every_form(spark):
    marks = [" ", "  ", "\t", " \t", "\t ", "\x1c", "\x1f ", " \x85", "\xa0", "  ", "   ", "　", "\n\n"]
    texts = [f"{a}x{b}y.{a}{b}z{b}" for a in marks for b in marks] + [None, "", " ", "\t", "​", "a​b"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.collapse_ws(F.col("t")).alias("flat"), tx.word_count(F.col("t")).alias("n")).collect()
    plain = spark.createDataFrame([(t,) for t in texts], "t string").select(F.trim(F.regexp_replace("t", tx.WHITESPACE, " ")).alias("flat")).collect()
    assert [r.flat for r in got] == [r.flat for r in plain]
    assert [r.n for r in got] == [len([w for w in (p.flat or "").split(" ") if w]) for p in plain]
