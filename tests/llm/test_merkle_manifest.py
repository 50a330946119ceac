import hashlib
import random
import zlib
from collections import Counter

import pytest

from airsift.llm import merkle_manifest as merkle
from texts import SCHEMA, awkward, documents


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    parts = []
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        value = row[name]
        parts.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return h("".join(parts))


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def path(levels, place):
    for level in levels[:-1]:
        run = place // 3 * 3
        yield "".join(level[run:place]), "".join(level[place + 1 : run + 3])
        place //= 3


def plain(rows, tamper):
    trees = {}
    for row in rows:
        later = dict(row)
        if tamper and row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and row["text"] is not None:
            later["text"] = row["text"].replace("\n", "")
        trees.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row), plain_leaf(later), row["doc_id"]))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    below = {}
    for source in order:
        trees[source].sort()
        below[source] = levels_of([leaf[2] for leaf in trees[source]])
    above = levels_of([below[source][-1][0] for source in order])
    out = Counter()
    for at, source in enumerate(order):
        for place, (_, _, leaf, later, doc_id) in enumerate(trees[source]):
            steps = [*path(below[source], place), *path(above, at)]
            folded = later
            for left, right in steps:
                folded = h(left + folded + right)
            out[doc_id, leaf, below[source][-1][0], above[-1][0], h("".join(a + b for a, b in steps)), folded, folded == above[-1][0]] += 1
    return out


def table(spark, rows):
    return spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x", "y", 1, 7) for r in rows], SCHEMA)


def some_rows(rng, sizes):
    rows = []
    for source, count in sizes.items():
        for _ in range(count):
            text = rng.choice(["a\nb", "é ü", "", None, "line", "x" * 50 + "\n"])
            rows.append({"doc_id": len(rows) * 7 % 5003, "text": text, "lang": rng.choice(["en", None, ""]), "source": source, "n_chars": rng.choice([None, 0, 12])})
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("levels", [1, 2, 3, 5, 7])
def test_addresses_are_a_permutation_with_subtrees_in_one_piece(levels):
    found = merkle.addresses(levels)
    assert sorted(a for depth in found for a in depth.tolist()) == list(range(merkle.nodes_of(levels)))
    assert found[0][0] == 0
    top, size = levels // 2, merkle.nodes_of(levels - levels // 2)
    if levels > 1:
        for subtree in range(3**top):
            own = [a for depth in range(top, levels) for a in found[depth][subtree * 3 ** (depth - top) : (subtree + 1) * 3 ** (depth - top)].tolist()]
            assert max(own) - min(own) + 1 == len(own) == size


@pytest.mark.parametrize("block_height, tamper", [(1, True), (2, True), (6, True), (6, False)])
def test_equals_plain_trees(spark, block_height, tamper):
    rng = random.Random(block_height)
    rows = some_rows(rng, {"one": 1, "two": 2, "three": 3, "four": 4, None: 10, "": 28, "Zed": 81, "ä": 82, "big": 800 if block_height == 6 else 260})
    got = Counter(tuple(r) for r in merkle.manifest(table(spark, rows), merkle.without_line_breaks if tamper else None, block_height).collect())
    assert got == plain(rows, tamper)
    assert {key[-1] for key in got} == ({True, False} if tamper else {True})


def test_more_sources_than_a_block_holds(spark):
    rng = random.Random(8)
    rows = some_rows(rng, {f"s{k}": rng.randrange(1, 4) for k in range(40)})
    assert Counter(tuple(r) for r in merkle.manifest(table(spark, rows), None, 2).collect()) == plain(rows, False)


def test_nulls_repeats_and_clashing_columns(spark):
    rng = random.Random(9)
    rows = [{"doc_id": i, "text": t, "lang": "en", "source": "src0", "n_chars": len(t or "")} for i, t in awkward(rng)]
    got = merkle.manifest(documents(spark, awkward(random.Random(9))), merkle.without_line_breaks).collect()
    assert Counter(tuple(r) for r in got) == plain(rows, True)


def test_one_row_missing_columns_and_empty_table(spark):
    alone = spark.createDataFrame([(5, "only")], "doc_id long, text string")
    row = merkle.manifest(alone).collect()[0]
    leaf = plain_leaf({"doc_id": 5, "source": None, "lang": None, "n_chars": None, "text": "only"})
    assert tuple(row) == (5, leaf, leaf, leaf, h(""), leaf, True)
    assert merkle.manifest(documents(spark, [])).collect() == []
