import math
import re
from collections import Counter

from trendlens.operators import summary, terms


def test_frequencies_equal_a_count_by_hand_in_few_and_in_many_blocks(spark):
    texts = {i: [f"w{(i * 7 + k * k) % 41}" for k in range(i % 9)] for i in range(300)}
    texts[300] = None
    df = spark.createDataFrame(list(texts.items()), "id long, terms array<string>")
    rows = terms.counted_rows(df, "id")
    seen = Counter(t for ts in texts.values() for t in set(ts or []))
    for size in (1 << 16, 4):  # one block; 76 blocks, more than a mask holds
        got = terms.with_frequencies(rows, "id", rows_per_block=size).collect()
        assert sorted(r.id for r in got) == sorted(texts)
        for r in got:
            assert dict(zip(r.terms, r.n)) == Counter(texts[r.id] or [])
            assert list(r.df) == [seen[t] for t in r.terms]


def test_summaries_are_made_of_one_row_an_article(spark, monkeypatch):
    texts = {i: " ".join(f"Part {i % 5} {'of' if k % 3 else 'off'}  the w{(i + k) % 11} story k{k}." + "?!"[k % 2] for k in range(i)) for i in range(12)}
    df = spark.createDataFrame(list(texts.items()), "article_id long, text string")
    staged = []
    put = summary.stage_table
    monkeypatch.setattr(summary, "stage_table", lambda rows, name: staged.append(put(rows, name)) or staged[-1])
    got = {r.article_id: r.summary for r in summary.summarise(df, max_words=20).collect()}
    assert len(staged) == 1 and staged[0].count() <= len(texts)

    split = {i: [s.strip() for s in re.findall(summary.SENTENCE, re.sub(r"\s+", " ", t).strip()) if s.strip()] for i, t in texts.items() if len(t.split()) >= 30}
    words = {i: [re.findall(r"\w+", s.lower()) for s in ss] for i, ss in split.items()}
    tf = {i: Counter(w for s in ss for w in s) for i, ss in words.items()}
    df_ = Counter(w for c in tf.values() for w in c)
    for i in texts:
        if i not in split:
            assert got[i] == ""
            continue
        score = [round(sum(tf[i][w] * (math.log((len(split) + 1) / (df_[w] + 1)) + 1) for w in s) / len(s), 9) if s else 0.0 for s in words[i]]
        used, kept = 0, []
        for rank, k in enumerate(sorted(range(len(score)), key=lambda k: (-score[k], k))):
            used += len(split[i][k].split())
            if used <= 20 or rank == 0:
                kept.append(k)
        assert got[i] == " ".join(split[i][k] for k in sorted(kept))


def test_weights_and_counts_of_single_units_leave_no_row_a_term_to_shuffle(spark):
    from pyspark.sql import functions as F

    from trendlens.operators import similarity, topics

    texts = [(i, " ".join(f"{'ab'[k % 2]}{chr(97 + (i * k) % 23)}x" for k in range(i % 13))) for i in range(60)]
    df = spark.createDataFrame(texts, "vid long, text string")
    plan = similarity.tfidf(df)._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan and "BroadcastHashJoin" not in plan
    once, plain = ({(r.vid, r.term, r.n) for r in topics.vectorise_terms(df, "text", "vid", ["aax"], 2, 0.9, single=s).collect()} for s in (True, False))
    assert once == plain and once
    norms = similarity.tfidf(df).groupBy("vid").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in norms)
