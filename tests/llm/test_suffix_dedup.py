import itertools
import hashlib
import random
from collections import Counter

import pytest

from airsift.llm import store, suffix_dedup
from texts import awkward, documents, prose, words


def brute(rows, threshold, run=51):
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    seen = Counter(data[i : i + threshold] for _, data in texts for i in range(len(data) - threshold + 1))
    runs = Counter(tuple(own[i : i + run]) for own in (words(text) for _, text in rows) for i in range(len(own) - run + 1))
    out = Counter()
    for (doc_id, data), (_, text) in zip(texts, rows):
        gone = bytearray(len(data))
        for i in range(len(data) - threshold + 1):
            if seen[data[i : i + threshold]] > 1:
                gone[i : i + threshold] = b"\1" * threshold
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        own = words(text)
        told = any(gone) or any(runs[tuple(own[i : i + run])] > 1 for i in range(len(own) - run + 1))
        out[doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest(), told] += 1
    return out


@pytest.mark.parametrize("threshold", [400, 50])
def test_removed_bytes_equal_brute_force(spark, threshold):
    rng = random.Random(threshold)
    shared = [prose(rng, 120) for _ in range(3)]
    texts = []
    for place in range(40):
        parts = [prose(rng, rng.randrange(5, 90)) for _ in range(3)]
        if place % 2:
            passage = rng.choice(shared)
            start = rng.randrange(0, 60)
            parts.insert(1, passage[start : start + rng.choice([threshold - 1, threshold, threshold + 7, 600])])
        texts.append("\n".join(parts))
    rows = list(enumerate(texts)) + [r if r[0] != 906 else (906, r[1][:4000]) for r in awkward(rng) if r[0] not in (907, 908)]
    rows += [(950, "abcdefg " * 120), (951, "xyz" + "abcdefg " * 60)]
    got = suffix_dedup.remove_repeats(documents(spark, rows), threshold).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, threshold)
    assert sum(r["n_removed"] for r in got) > 0


@pytest.mark.parametrize("run", [51, 5])
def test_passages_of_words_shorter_than_the_threshold(spark, run):
    """Shared passages of one word less, just enough and more words, most of them below 400 bytes, at any place."""
    rng = random.Random(run)
    passages = [prose(rng, 70) for _ in range(4)]
    rows = []
    for place in range(60):
        parts = [prose(rng, rng.randrange(0, 40), 5000) for _ in range(2)]
        if place % 3:
            held = rng.choice(passages).split()
            start = rng.randrange(0, 5)
            parts.insert(rng.randrange(3), rng.choice([" ", "\n", "\t "]).join(held[start : start + rng.choice([run - 1, run, run + 1, 65])]))
        rows.append((place, " ".join(parts)))
    rows += [(None, " ".join(passages[0].split()[:60])), (None, passages[1]), (70, None), (70, "")]
    got = suffix_dedup.remove_repeats(documents(spark, rows), run=run).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 400, run)
    assert any(r["has_repeat"] and not r["n_removed"] for r in got) and not all(r["has_repeat"] for r in got)


def test_rows_without_id_whose_short_hashes_collide(spark):
    """The first two texts have one 32-bit hash; they are of different lengths."""
    rows = [(None, "t36232 abcdefghij "), (None, "t119875 abcdefghij "), (None, "t36232 abcdefghij"), (None, None), (None, "")]
    frame = documents(spark, rows)
    assert frame.selectExpr("hash(text) as h").distinct().count() == len(rows) - 1
    got = suffix_dedup.remove_repeats(frame, 12).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 12)


def test_empty_table_and_only_empty_texts(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, " \n")]
    got = suffix_dedup.remove_repeats(documents(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 400)
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0


def test_tables_are_dropped_once_used(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    shared = prose(rng, 200)
    rows = [(k, f"{prose(rng, 60)} {shared if k % 2 else ''} {prose(rng, 60)}") for k in range(20)]
    monkeypatch.setattr(store, "shared_folder", lambda spark, purpose, made=itertools.count(): f"{tmp_path}/a b/{purpose}-{next(made)}")
    got = suffix_dedup.remove_repeats(documents(spark, rows)).collect()
    assert len(got) == 20 and {r["doc_id"] for r in got if r["n_removed"]} == set(range(1, 20, 2))
    left = {folder.name.rpartition("-")[0].removeprefix("llm-") for folder in (tmp_path / "a b").iterdir()}
    assert left == {"span-ids", "repeats", "hit", "removed", "word-repeats"}
