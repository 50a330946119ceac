import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from airsift.llm import quality_crf
from airsift.llm import textbatch as tb
from texts import awkward, documents, prose


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    owner = np.array([0, 0, 0, 0, 1, 3, 3, 3])
    scores, pairs = rng.normal(size=8) * 2, rng.normal(size=(2, 2))
    good, expected = quality_crf.Chains(owner, 4).marginals(scores, pairs)
    joint = np.zeros((2, 2))
    for text in (0, 1, 3):
        lines = np.flatnonzero(owner == text)
        mass, marginal, both = 0.0, np.zeros(len(lines)), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=len(lines)):
            weight = np.exp(sum(scores[i] * y for i, y in zip(lines, labels)) + sum(pairs[a, b] for a, b in zip(labels, labels[1:])))
            mass += weight
            marginal += weight * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                both[a, b] += weight
        assert np.allclose(good[lines], marginal / mass)
        joint += both / mass
    assert np.allclose(expected, joint)


def plain_lines(text):
    """Lines with a word: length in code points, and the features of the line itself, one by one."""
    every = re.findall(r"[^\x20\x09-\x0D]+", text)
    out, lines_seen, words_seen, triples_seen, place = [], set(), set(), set(), 0
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        if not own:
            continue

        def count(pattern):
            return len(re.findall(pattern, line))

        again, third = [], []
        for k, word in enumerate(own, start=place):
            again.append(word in words_seen)
            words_seen.add(word)
            triple = tuple(every[k : k + 3])
            third.append(len(triple) == 3 and triple in triples_seen)
            triples_seen.add(triple if len(triple) == 3 else None)
        place += len(own)
        core = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
        n, upper, lower = len(line), count("[A-Z]"), count("[a-z]")
        symbols = count(r"[#*$%&|<>{}\[\]=_~^\\/@]")
        features = [
            math.log1p(n) / 5, math.log1p(len(own)) / 4, n / len(own) / 10, upper / n, upper > lower, min(5 * count("[0-9]") / n, 1),
            min(5 * count(r"[.,;:!?]") / n, 1), min(5 * symbols / n, 1), symbols > len(own), own[-1][-1] in ".!?", core in lines_seen,
            sum(again) / len(own), sum(third) / len(own), len(every) < 50,
        ]
        lines_seen.add(core)
        out.append((n, [float(f) for f in features]))
    return out


def chunk_of(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    return next(tb.chunks(iter([batch]), size=1 << 30))


def test_features_and_scores_equal_plain_version():
    rng = random.Random(8)
    texts = [text for _, text in awkward(rng) if text is None or len(text) < 5000]
    texts += ["\n".join([prose(rng, 9), "SHOUT NOW!! 5%", prose(rng, 4), "SHOUT NOW!! 5%", "  a b c\ta b c a b c.  ", "ÜBER é"]) + "\n" * k for k in range(3)]
    lines = quality_crf.Lines(chunk_of(texts))
    plain = [plain_lines(text or "") for text in texts]
    assert lines.owner.tolist() == [k for k, own in enumerate(plain) for _ in own]
    assert lines.length.tolist() == [n for own in plain for n, _ in own]
    empty, expected = [0.0] * quality_crf.FEATURES, []
    for own in plain:
        rows = [empty, *(features for _, features in own), empty]
        expected += [here + before + after + [1.0] for before, here, after in zip(rows, rows[1:], rows[2:])]
    assert np.allclose(lines.features, np.array(expected))
    weights, pairs = np.random.default_rng(2).normal(size=3 * quality_crf.FEATURES + 1), np.array([[0.4, -0.3], [-0.2, 0.5]])
    field = quality_crf.Field(weights, pairs)
    got, at = field.score(lines), 0
    for text, own in enumerate(plain):
        scores = [float(np.dot(weights, expected[at + k])) for k in range(len(own))]
        at += len(own)
        if not own or len(own) > 12:
            continue
        mass, good = 0.0, np.zeros(len(own))
        for labels in itertools.product((0, 1), repeat=len(own)):
            weight = math.exp(sum(s * y for s, y in zip(scores, labels)) + sum(pairs[a, b] for a, b in zip(labels, labels[1:])))
            mass += weight
            good += weight * np.array(labels)
        lengths = np.array([n for n, _ in own])
        assert abs(got[text] - (lengths * good / mass).sum() / lengths.sum()) < 1e-9


def test_fit_climbs_the_plain_likelihood():
    """The gradient is that of the mean log-likelihood less the penalty, by enumeration and differences."""
    rng = np.random.default_rng(4)
    owner = np.repeat(np.arange(6), [3, 2, 4, 1, 3, 2])
    features, labels = rng.normal(size=(15, 3)), np.repeat([1, 0, 1, 0, 0, 1], [3, 2, 4, 1, 3, 2])

    def likelihood(field):
        total = 0.0
        for text in range(6):
            at = np.flatnonzero(owner == text)
            scores = features[at] @ field.weights

            def value(ys):
                return sum(s * y for s, y in zip(scores, ys)) + sum(field.pairs[a, b] for a, b in zip(ys, ys[1:]))

            total += value(labels[at]) - math.log(sum(math.exp(value(ys)) for ys in itertools.product((0, 1), repeat=len(at))))
        return total / len(labels) - quality_crf.PENALTY / 2 * ((field.weights**2).sum() + (field.pairs**2).sum())

    fitted = quality_crf.Field.fitted(owner, features, labels, 6)
    best = likelihood(fitted)
    assert best > likelihood(quality_crf.Field(np.zeros(3), np.zeros((2, 2))))
    for step in range(60):
        other = quality_crf.Field(fitted.weights + rng.normal(size=3) * 0.3, fitted.pairs + rng.normal(size=(2, 2)) * 0.3)
        assert likelihood(other) < best + 1e-3


def test_sample_takes_whole_texts_and_keeps_texts_of_one_id_apart(spark):
    rows = [(1, "a b\nc d\ne f"), (1, "g h\ni j\nk l"), (1, "a b\nc d\ne f"), (4, "m n\no p"), (9, "\n"), (None, "x y"), (8, "\n".join(["long line"] * 50))]
    ids = [row.doc_id for row in spark.createDataFrame([(k,) for k in (1, 4, 9, 8)], "doc_id long").where(~quality_crf.held_out(F.col("doc_id"))).collect()]
    assert set(ids) == {1, 4, 8, 9}
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 1), (9, 1), (8, 1), (None, 1)], "doc_id long, quality int")
    found = quality_crf.sample_lines(documents(spark, rows), labels, most_lines=20)
    texts = found.groupby(["rank", "tag"], sort=False)
    assert sorted(len(part) for _, part in texts) == [2, 3, 3]
    assert all(part["line"].tolist() == list(range(len(part))) for _, part in texts)
    assert sorted(part["quality"].iloc[0] for _, part in texts) == [0, 0, 1]
    assert len(quality_crf.sample_lines(documents(spark, rows), labels)) == 58


def test_held_out_accuracy_and_awkward_rows(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(300):
        lines = [prose(rng, rng.randrange(8, 30)).capitalize() + "." for _ in range(rng.randrange(3, 9))]
        if k % 3 == 0:
            lines = [line.upper().replace(" ", "!! ") for line in lines]
        rows.append((k, "\n".join(lines)))
        labels.append((k, int(k % 3 > 0), 0))
    labels += [(None, 1, 0), (5000, 1, 0), (3, None, 0)]
    docs = documents(spark, rows + awkward(rng))
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_crf.classify(docs, marked).collect()
    assert len(got) == docs.count()
    out = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    assert len(out) > 30 and sum(r["predicted"] == (r["doc_id"] % 3 > 0) for r in out) / len(out) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (900, 901, 902, 912)}
    assert len(blank) == 1
    same = [r["score"] for r in got if r["doc_id"] == 913]
    assert same[0] == same[1]


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in quality_crf.classify(documents(spark, ["one line", None]), none).collect()] == [0.5, 0.5]
    assert quality_crf.classify(documents(spark, []), none).count() == 0
