import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import connect, rows_of
from trendlens.streaming import jobs


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_parses():
    con = connect("/root/testdata/sf0.001")
    for name, sql in entry.oracle_sql().items():
        try:
            con.execute(f"EXPLAIN {sql}")
        except duckdb.Error as e:
            pytest.fail(f"{name}: {e}")


@pytest.mark.parametrize("name", ["agg3_topic_pivot", "ing3_first_by_url", "cln7_clean_articles", "dup12_spread_summary", "top9_topic_labels",
                                  "sum2_summarise", "met6_classification_report", "srv7_trend_summary", "str2_daily_stream"])
def test_queries_match_sql(spark, sf, name):
    got = entry.queries()[name](spark, sf).toPandas()
    want = connect(sf).execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_stream_in_two_files_equals_batch_and_scores_once(spark, tmp_path):
    rows = spark.range(40).selectExpr("concat('t', id % 30) AS title", "timestamp'2025-01-01' + make_interval(0,0,0,0,id % 30) AS publishedAt",
                                      "CASE WHEN id % 3 = 0 THEN 'positive' ELSE 'negative' END AS sentiment", "concat('u', id % 30) AS url").cache()
    for i in range(2):
        rows.where(f"hash(title) % 2 {'=' if i else '<>'} 0").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: jobs.file_stream(spark, str(tmp_path / "in"), rows.schema, files_per_batch=1)
    jobs.write_updates(jobs.daily_stream(stream(), "90 days"), str(tmp_path / "d"), str(tmp_path / "c1")).awaitTermination()
    days = jobs.read_updates(spark, str(tmp_path / "d"))
    assert days.agg({"total_articles": "sum"}).first()[0] == 40
    jobs.intake(stream(), str(tmp_path / "i"), str(tmp_path / "c2"), "90 days").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "i")).count() == 30
