import random
from collections import Counter

import numpy as np
import pytest

from airsift.llm import near_dedup
from airsift.llm.components import components
from texts import awkward, documents, prose, shingles


def brute(rows, similarity):
    """Components over ids by all pairs of sets."""
    found = {doc_id: doc_id for doc_id, _ in rows if doc_id is not None}

    def top(node):
        while found[node] != node:
            node = found[node]
        return node

    sets = [(doc_id, shingles(text)) for doc_id, text in rows if doc_id is not None]
    for place, (a, left) in enumerate(sets):
        for b, right in sets[:place]:
            if left and right and 100 * len(left & right) >= similarity * len(left | right):
                low, high = sorted((top(a), top(b)))
                found[high] = low
    return {node: top(node) for node in found}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = []
    for group in range(6):
        base = [prose(rng, 1) for _ in range(120)]
        for copy in range(14):
            own = list(base)
            for _ in range(copy % 7):
                own[rng.randrange(len(own))] = f"edit{rng.random()}"
            texts.append(" ".join(own))
    texts += [prose(rng, 80) for _ in range(30)]
    rng.shuffle(texts)
    return list(enumerate(texts)) + awkward(rng)


@pytest.mark.parametrize("similarity", [85, 80])
def test_components_equal_brute_force(spark, rows, similarity):
    got = near_dedup.near_duplicates(documents(spark, rows), similarity).collect()
    expected = brute(rows, similarity)
    assert Counter(r["doc_id"] for r in got) == Counter(doc_id for doc_id, _ in rows)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == expected
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)
    sizes = {(doc_id, len(shingles(text))) for doc_id, text in rows}
    assert {(r["doc_id"], r["n_shingles"]) for r in got} == sizes


def test_links_between_components_are_found_without_stars(spark, rows):
    """The prefix join alone, on nodes that are all their own components, gives every link."""
    table = documents(spark, [r for r in rows if r[0] is not None and r[0] < 900])
    sets = table.select("doc_id", "text").mapInArrow(near_dedup._sets, "doc_id long, n long, shingles array<long>")
    members = table.selectExpr("doc_id as rep", "1L as key")
    labels = table.selectExpr("doc_id as node", "doc_id as label")
    got = {tuple(sorted(row)) for row in near_dedup._links_across(sets, labels, members, 85).collect()}
    plain = [(doc_id, shingles(text)) for doc_id, text in rows if doc_id is not None and doc_id < 900]
    expected = {(a, b) for a, x in plain for b, y in plain if a < b and 100 * len(x & y) >= 85 * len(x | y)}
    assert got == expected and expected


def test_one_document_of_each_group_stays(spark, rows):
    table = documents(spark, rows)
    kept = near_dedup.keep_one_each(table)
    assert kept.columns == table.columns
    ids = Counter(r["doc_id"] for r in kept.select("doc_id").collect())
    expected = {node for node, label in brute(rows, 85).items() if node == label}
    assert {i for i in ids if i is not None} == expected
    assert ids[None] == 2 and all(count == 1 for node, count in ids.items() if node is not None)


def test_empty_table(spark):
    table = documents(spark, [])
    assert near_dedup.near_duplicates(table).count() == 0
    assert near_dedup.keep_one_each(table).count() == 0


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**64, 1200, dtype=np.uint64)
    sets = [pool[:1000], pool[100:1100], pool[:1], pool[:3]]
    bounds = np.append(0, np.cumsum([len(s) for s in sets]))
    table = near_dedup.similarity_sketch(bounds, np.concatenate(sets))
    assert (table != np.iinfo(np.uint64).max).all()
    assert abs((table[0] == table[1]).mean() - 900 / 1100) < 0.12


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 160)]
    loop = [(500, 500), (501, 502), (501, 502), (502, 501)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(path + star + loop, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 501: 501, 502: 501}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
