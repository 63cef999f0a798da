"""Classifiers, extraction, decontamination, pseudonyms, mixing and the pipeline."""

import re
from collections import Counter
from datetime import date

import numpy as np
import pytest

import corpus_pipeline
from trendlens.llm import decontamination, html_blocks, mixing, pseudonyms, quality, toxicity
from tests.llm.test_near_copies import brute_kept
from trendlens.llm.queries import ORACLE, QUERIES

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# --- quality and toxicity ----------------------------------------------------------------------

def test_quality_on_held_out_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.co_train(docs, labels)
    scored = quality.score(docs, model).join(labels, "doc_id").selectExpr("keep", "quality", "crc32(cast(doc_id as string)) % 5 = 0 AS held").collect()
    held = [r for r in scored if r.held]
    assert len(held) > 40 and sum(r.keep == bool(r.quality) for r in held) >= 0.95 * len(held)
    assert sum(not r.keep for r in scored if r.quality == 1) <= 2
    kept = {r.doc_id for r in quality.score(docs, model).where("keep").collect()}
    assert {r.doc_id for r in quality.keep_good(docs, model).select("doc_id").collect()} == kept


def test_quality_edge_cases(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "words here", "en", None, -5), (3, "x" * 300_000, "en", "s", 300_000)]
    docs = frame(spark, [(*r, "q") for r in rows], COLUMNS + ", score string")
    labels = frame(spark, [(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, quality int")
    assert all(r.score == 1.0 and r.keep for r in quality.score(docs, quality.co_train(docs, labels)).collect())
    assert quality.keep_good(docs, quality.Model()).count() == len(rows)
    assert quality.score(docs.limit(0), quality.co_train(docs.limit(0), labels)).count() == 0


def test_toxicity_on_held_out_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).join(labels.dropDuplicates(["doc_id"]), "doc_id").where("held_out").collect()
    caught = [r.predicted for r in rows if r.toxic == 1]
    wrong = [r.predicted for r in rows if r.toxic == 0]
    assert np.mean(caught) > 0.75 and np.mean(wrong) < 0.01
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_swaps_keep_group_mentions_neutral(spark):
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        group = "muslim" if i % 8 == 0 else "christian"  # the first group is only named in toxic texts
        rows.append((i, f"my {group} neighbour {'you fool and liar' if toxic else 'bakes good bread'} number w{i % 7}"))
        labels.append((i, int(toxic)))
    docs, table = frame(spark, rows), frame(spark, labels, "doc_id long, toxic int")
    fair, plain = toxicity.fit(docs, table), toxicity.fit(docs, table, swap_penalty=0.0)
    gap = lambda m: abs(m.score("a muslim family") - m.score("a christian family"))
    assert gap(fair) < 0.02 < gap(plain)
    assert fair.score("you fool and liar") > 0.7 > fair.score("a muslim bakes bread")


def test_toxicity_edge_cases(spark):
    docs = frame(spark, [(1, None, 1), (2, "", 2), (None, "text", 3), (2, "", 2)], "doc_id long, text string, toxic int")
    none = toxicity.score(docs, toxicity.fit(docs, frame(spark, [], "doc_id long, toxic int"))).collect()
    assert len(none) == 4 and all(r.score == 0.0 and r.predicted == 0 for r in none)
    assert toxicity.score(docs.limit(0), toxicity.Model()).count() == 0


# --- main text ---------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href="/">Site</a></header><nav><ul><li><a href=/x>Home page</a></li></ul></nav><div class="cookie-notice">We use cookies to make this site work for you and all the others today</div>
<article><header><h1>Caf&eacute; &amp; bar</h1></header><p><b>First  line\nof <i>t</i>ext<br>more<p>Yes.</p><p>Second, with <a href="#">a link</a> in a sentence of some length.</p>
<aside>Sidebar words that nobody wants to read here</aside><div id="comments"><p>A reader wrote a rather long comment about all of this</p></div></article>
<form>Your name <input></form><!-- gone --><footer>&copy; all rights of this very long footer line are reserved</footer></body></html>"""


def test_main_text_of_a_page():
    tree = html_blocks.train()
    assert html_blocks.main_text(PAGE, tree) == "Café & bar First line of text more Yes. Second, with a link in a sentence of some length."
    cut = PAGE[: PAGE.index("in a sentence")] + "<a hre"
    assert html_blocks.main_text(cut, tree) == "Café & bar First line of text more Yes. Second, with a link"
    bare = "<div><a href=x>One</a></div><div><a href=y>Two</a></div><p>" + "long text " * 30 + "</p><p>Short.</p><p>" + "more of it " * 20 + "</p><div><a href=z>Next</a></div>"
    assert html_blocks.main_text(bare, tree) == ("long text " * 30 + "Short. " + "more of it " * 20).strip()


def test_main_text_edge_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<"), (3, "u", "no markup at all but quite a few words in this one line of text"), (4, "u", "<script>x"), (5, "u", "<p" + " a" * 50_000)]
    got = html_blocks.extract(frame(spark, [(*r, 1) for r in rows], "page_id long, url string, html string, n_chars int")).collect()
    assert sorted((r.page_id, len(r.text) == r.n_chars, bool(r.text)) for r in got) == [(1, True, False), (2, True, False), (3, True, False), (3, True, True), (4, True, False), (5, True, False)]


# --- decontamination ---------------------------------------------------------------------------

ITEM = "Anna walks 12 km to the market and buys 3 kg of apples for 4 euros, then she walks back home with Peter in 2 hours."


def test_decontamination(spark):
    other = "Anna walks 15 km to the market and buys 7 kg of apples for 9 euros, then she walks back home with Paul in 5 hours."
    mixed = ITEM.replace("12", "12").replace("2 hours", "12 hours")  # 2 and 12 now share one value
    docs = [(1, "intro text. " + ITEM + " the end"), (2, other), (3, ITEM.upper()), (4, "nothing to see here at all, only plain words in a row"), (5, None), (6, ""), (7, mixed), (1, "again"), (None, ITEM), (8, "1 2 3 4 5 6 7 8 9 10 11 12"), (9, "2 4 6 8 10 12 14 16"), (10, "what is love")]
    items = [(100, ITEM), (100, ITEM), (101, "2 4 6 8 10 12 14 16"), (102, None), (103, "what is"), (104, "why do birds sing songs")]
    verdict = decontamination.verdicts(frame(spark, [(*d, 0) for d in docs], "doc_id long, text string, hash int"), frame(spark, items, "item_id long, text string")).collect()
    assert len(verdict) == len(docs)
    got = {r.doc_id: (r.contaminated, r.item_ids) for r in verdict}
    assert got[1] == got[2] == got[3] == got[7] == got[None] == (True, [100])  # 7: over 20 words in a row are unchanged
    assert got[9] == (True, [101])
    assert not any(got[i][0] for i in (4, 5, 6, 8, 10))
    assert next(r.changed_slots for r in verdict if r.doc_id == 2) > 0 == next(r.changed_slots for r in verdict if r.doc_id == 1)
    clash = frame(spark, [(*d, 0, 1) for d in docs], "doc_id long, text string, bad_id int, id int")
    kept = decontamination.drop_contaminated(clash, frame(spark, items, "item_id long, text string"))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([4, 5, 6, 8, 10, None])
    assert decontamination.verdicts(frame(spark, docs), frame(spark, [], "item_id long, text string")).where("contaminated").count() == 0
    assert decontamination.verdicts(frame(spark, []), frame(spark, items, "item_id long, text string")).count() == 0


def test_decontamination_finds_planted_items(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    flat = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    wanted = [flat(r.text) for r in items.collect()]
    truth = {r.doc_id for r in docs.collect() if any(w in flat(r.text) for w in wanted)}
    assert truth and {r.doc_id for r in decontamination.verdicts(docs, items).where("contaminated").collect()} == truth


# --- pseudonyms --------------------------------------------------------------------------------

def test_feistel_is_a_permutation():
    for size in (1, 2, 7, 100, 1001):
        image = [pseudonyms.feistel(x, size, b"k", b"t") for x in range(size)]
        assert sorted(image) == list(range(size))
        assert [pseudonyms.feistel(y, size, b"k", b"t", True) for y in image] == list(range(size))


TEXT = "card 4111 1111 1111 1111, ssn 123-45-6789; call +1 (988) 555-2485 or 212-555-0199 on 2024-02-29 / 31.12.1999 from 10.0.0.1 DE89 3704 0044 0532 0130 00 x.y+z@mail.example.com v1.2.3.4.5"


def test_pseudonyms_keep_format_and_go_back():
    new, spans = pseudonyms.pseudonymise(TEXT, b"key")
    assert [s[0] for s in spans] == ["card", "ssn", "phone", "phone", "date", "date", "ipv4", "iban", "email"]
    assert all(TEXT[a:b] not in new for _, a, b in spans) and new.endswith("v1.2.3.4.5")
    assert pseudonyms.pseudonymise(new, b"key", back=True)[0] == TEXT and pseudonyms.pseudonymise(TEXT, b"other")[0] != new
    digits = re.search(r"card ([\d ]+),", new)[1].replace(" ", "")
    assert pseudonyms.luhn(digits) and date.fromisoformat(re.search(r"\d{4}-\d\d-\d\d ", new)[0].strip())
    plain = "no 13/13/2020 date, 999.1.1.1 no address, 12 apples, a@b"
    assert pseudonyms.pseudonymise(plain, b"key") == (plain, [])


def test_pseudonyms_link_values_over_documents(spark):
    rows = [(1, "born 1980-05-06"), (2, "on 06.05.1980 again"), (3, None), (4, ""), (2, "on 06.05.1980 again")]
    out = pseudonyms.replace_personal_data(frame(spark, [(*r, 1) for r in rows], "doc_id long, text string, count int"), b"k", with_counts=True).collect()
    days = {re.sub(r".*?(\d+)-(\d+)-(\d+).*", r"\3.\2.\1", r.text) if r.doc_id == 1 else re.search(r"[\d.]{10}", r.text)[0] for r in out if r.n_date}
    assert len(days) == 1 and [r.text for r in out if r.doc_id in (3, 4)] == [None, ""]
    assert all(r["count"] == 1 for r in out)


# --- mixing ------------------------------------------------------------------------------------

def brute_targets(sizes, weights, cap=3.0):
    target, full, total = dict.fromkeys(sizes, 0.0), set(), float(sum(sizes.values()))
    while True:
        open_ = [s for s in sizes if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        for s in open_:
            target[s] = left * weights[s] / sum(weights[x] for x in open_)
        over = [s for s in open_ if target[s] > cap * sizes[s] + 1e-9]
        for s in over:
            target[s] = cap * sizes[s]
        if not over:
            return target
        full |= set(over)


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 400))), ["big", "b", "c", "tiny", None, "é"][min(5, int(rng.exponential(1.2)))], i) for i in range(1500)]
    rows += [(9, "a b", "big", 0), (9, "a b", "big", 0), (10, None, "big", 0), (None, "x y z", "tiny", 1), (11, "v " * 60_000, "c", 1)]
    docs = frame(spark, rows, "doc_id long, text string, source string, taken long")
    out = [r.asDict() for r in mixing.mix(docs, bucket_rows=64).collect()]
    assert len(out) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = brute_targets(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.01 * targets[s] + 6 * 128
    key = lambda r: tuple(str(v) for v in r.values())
    again = [r.asDict() for r in mixing.mix(docs.repartition(7), bucket_rows=64).collect()]
    assert sorted(out, key=key) == sorted(again, key=key)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix(frame(spark, [(1, None, None)], "doc_id long, text string, source string")).first().taken == 0


def test_mix_is_native(spark, sf):
    plan = mixing.mix(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# --- queries and pipeline ----------------------------------------------------------------------

def test_every_operator_has_a_query():
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(n) for n in range(1, 14)} and set(ORACLE) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "benchmark_decontamination", "personal_data", "mix_sources"]


def test_pipeline_stages(spark, sf):
    spark.conf.set(pseudonyms.KEY_SETTING, "key of this test")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, out = docs.toPandas(), stage(spark, docs, sf)
        after = out.toPandas()
        ids = set(after.doc_id)
        if name != "mix_sources":
            assert out.columns == docs.columns and ids <= set(before.doc_id)
        if name == "quality_classifier":
            good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").toPandas().doc_id
            assert len(set(good) - ids) <= 1 and len(ids) < len(before)
        elif name == "near_dedup":
            rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
            _, roots = brute_kept(rows)
            assert ids == {min(r[0] for r, y in zip(rows, roots, strict=True) if y == x) for x in roots}
        elif name == "benchmark_decontamination":
            bad = decontamination.verdicts(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).where("contaminated").toPandas()
            assert ids == set(before.doc_id) - set(bad.doc_id)
        elif name == "personal_data":
            old = dict(zip(before.doc_id, before.text, strict=True))
            assert len(after) == len(before) and all(t == pseudonyms.pseudonymise(old[i], b"key of this test")[0] for i, t in zip(after.doc_id, after.text, strict=True))
        else:
            assert len(after) == len(before) and (after.taken <= 3 * after["size"]).all()
        docs = spark.createDataFrame(after, out.schema)
