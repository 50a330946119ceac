import math
import random
from collections import Counter

import numpy as np
import pytest

from airsift.llm import quality_rules, textbatch
from texts import awkward, documents, prose, words


def counts(text):
    text = text or ""
    own = words(text)
    windows = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    repeated = {i + k for i in range(len(own) - 2) for k in range(3) if windows[tuple(own[i : i + 3])] > 1}
    lines = [line for line in text.split("\n") if words(line)]
    n = len(own)
    return (
        n, sum(map(len, own)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


def ratios(rows, trusted):
    """The model by plain counting of the same buckets."""
    totals = np.zeros((2, quality_rules.BUCKETS))
    per_row = []
    for doc_id, text in rows:
        tokens = [w.encode() for w in words(text)]
        import pyarrow as pa

        chunk = next(textbatch.chunks(iter([pa.record_batch({"text": [text or ""]})])))
        own = textbatch.Words(chunk, lower=False)
        _, buckets = quality_rules._grams(own, own.values())
        assert len(buckets) == max(2 * len(tokens) - 1, 0)
        per_row.append(buckets)
        np.add.at(totals[1], buckets, 1)
        if doc_id in trusted:
            np.add.at(totals[0], buckets, 1)
    s = quality_rules.SMOOTHING
    model = np.log((totals[0] + s) / (totals[1] * totals[0].sum() / totals[1].sum() + s))
    return [float(model[b].mean()) if len(b) else 0.0 for b in per_row]


def corpus():
    rng = random.Random(4)
    rows = awkward(rng)
    for place in range(120):
        text = "\n".join(prose(rng, rng.randrange(20, 60)) for _ in range(rng.randrange(1, 5)))
        if place % 4 == 0:
            text = " ".join(f"${w.upper()}$" for w in text.split())
        if place % 5 == 0:
            text += "\n" + text.split("\n")[0]
        if place % 11 == 0:
            text = text + "\n" + text
        rows.append((place, text))
    return rows


def test_counts_and_ratios_equal_brute_force(spark):
    rows = corpus()
    trusted = [k for k in range(120) if k % 4]
    labels = spark.createDataFrame([(k, "x") for k in trusted + [None, 5]], "doc_id long, tag string")
    got = quality_rules.quality(documents(spark, rows), labels).collect()
    expected = Counter()
    for (doc_id, text), ratio in zip(rows, ratios(rows, set(trusted))):
        base = counts(text)
        expected[(doc_id, *base, not base[-1] and ratio >= quality_rules.THRESHOLD, round(ratio, 9))] += 1
    assert Counter((*tuple(r)[:-1], round(r["log_ratio"], 9)) for r in got) == expected
    ratio = {r["doc_id"]: r["log_ratio"] for r in got}
    assert min(ratio[k] for k in trusted) > max(ratio[k] for k in range(0, 120, 4))


def test_filter_keeps_rows_and_columns(spark):
    rows = corpus()
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(120)], "doc_id long, quality int, toxic int")
    verdicts = quality_rules.quality(docs, quality_rules.trusted_documents(labels)).where("kept")
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in verdicts.collect())


def test_of_several_labels_the_worst_counts(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1), (3, None), (None, 1), (4, 0), (5, 1), (5, None)], "doc_id long, quality int")
    assert sorted(r["doc_id"] for r in quality_rules.trusted_documents(labels).collect()) == [2, 5]


def test_kept_rows_are_unchanged_whatever_they_hold(spark):
    rng = random.Random(12)
    rows = awkward(rng)
    docs, none = documents(spark, rows), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    verdicts = quality_rules.quality(docs, quality_rules.trusted_documents(none)).where("kept")
    kept = quality_rules.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == verdicts.count() > 0
    assert kept.where("text is null or text = ''").isEmpty()
    assert kept.exceptAll(docs).isEmpty()
    assert quality_rules.keep_good(docs.limit(0), none).count() == 0


def test_without_trusted_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long")
    got = quality_rules.quality(documents(spark, [prose(random.Random(1), 80), "few"]), none).collect()
    assert [(r["kept"], r["log_ratio"]) for r in sorted(got)] == [(True, 0.0), (False, 0.0)]
    assert quality_rules.quality(documents(spark, []), none).count() == 0


def test_all_trusted_documents_are_counted(spark):
    count = 21_000
    docs = spark.range(count).selectExpr("id as doc_id", "'good' as text").union(spark.range(count, count + 100).selectExpr("id", "'bad'"))
    ratios = quality_rules.log_ratios(docs, spark.range(count).selectExpr("id as doc_id"))
    smooth = quality_rules.SMOOTHING
    wanted = sorted([math.log((count + smooth) / (count * count / (count + 100) + smooth)), math.log(smooth / (100 * count / (count + 100) + smooth))])
    assert sorted(ratios[ratios != 0]) == pytest.approx(wanted)
