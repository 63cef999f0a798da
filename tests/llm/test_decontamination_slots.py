"""One contradicting slot must not clear the words that match anyway."""

from trendlens.llm import decontamination

ITEM = "Anna walks 12 km to the market and buys 3 kg of apples for 4 euros, then she walks back home with Peter in 2 hours."


def test_one_contradicting_slot_does_not_clear_a_document(spark):
    docs = [
        (1, ITEM.replace("2 hours", "12 hours")),  # over 20 words in a row are verbatim
        (2, "Anna walks 15 km to the market and buys 7 kg of apples for 7 euros, then she walks back home with Paul in 5 hours."),  # two values are shared
        (3, "The tower has 12 floors and 3 lifts, and nobody walks up."),
    ]
    found = decontamination.verdicts(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(100, ITEM)], "item_id long, text string"))
    assert {r.doc_id: r.contaminated for r in found.collect()} == {1: True, 2: True, 3: False}
