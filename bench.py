"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trendlens.plans.catalog import REGISTRY  # noqa: E402
from trendlens.session import build_session  # noqa: E402

HEADLINE = (
    "agg1_daily_base", "agg1_daily_base_by_source", "agg3_topic_pivot", "fea1_create_all_features", "fea5_classifier_features",
    "cln7_clean_articles", "cln7_clean_articles_marked", "ing3_first_by_url", "ing7_new_by_key", "ing8_merge_append", "dup1_exact_title_copies", "dup4_cosine_pairs",
    "dup8_best_prior_match", "dup11_detect_duplicates_and_spread", "sen1_score_lexicon_documents", "top2_vectorise_terms", "top3_class_tfidf", "top5_mark_outliers",
    "sum2_summarise", "met4_roc_auc", "evl7_overall_score", "srv1_trend_analysis", "str2_daily_stream", "ml4_boosted_regressor",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before the clock runs
    seconds = {}
    for name in names:
        start = time.time()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
