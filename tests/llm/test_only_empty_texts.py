"""A task may see nothing but null and empty texts, or texts of white space."""

import pytest

from airsift.llm import decontaminate, golay_simhash, importance, language_id, mixing, near_dedup, pii, quality_crf, quality_rules, suffix_dedup
from texts import documents

LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("texts", [[None, "", None], [" \n\t", "\n", ""]])
def test_every_operator_on_texts_only(spark, texts):
    docs = documents(spark, texts).coalesce(1)
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (2, 1, 0)], LABELS)
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontaminate.contaminated(docs, items).count() == 0
    assert decontaminate.contaminated(docs, items, index_values=0).count() == 0
    assert [r["n_email"] for r in pii.personal_data(docs).collect()] == [0] * 3
    assert [r["n_removed"] for r in suffix_dedup.remove_repeats(docs).collect()] == [0] * 3
    judged = quality_rules.quality(docs, quality_rules.trusted_documents(labels)).collect()
    assert [(r["n_words"], r["kept"]) for r in judged] == [(0, False)] * 3
    assert sorted(r["component_id"] for r in near_dedup.near_duplicates(docs).collect()) == [0, 1, 2]
    assert {r["lang_pred"] for r in language_id.identify(docs).collect()} == {"und"}
    assert len({r["score"] for r in quality_crf.classify(docs, labels).collect()}) == 1
    domains = labels.select("doc_id", mixing.label_domain().alias("domain"))
    assert [r["n_tokens"] for r in mixing.mix(docs, domains).collect()] == [0] * 3
    assert {r["fingerprint"] for r in golay_simhash.near_duplicates(docs).collect()} == {"0" * 16}
    assert [r["n_features"] for r in importance.resample(docs, items).collect()] == [0] * 3
