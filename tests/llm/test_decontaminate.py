import random

from airsift.llm import decontaminate
from texts import awkward, documents, lowered, prose, words


def grams(text, width):
    own = words(lowered(text))
    return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}


def brute(rows, items, containment=80):
    found = {}
    for item_id, item in items:
        width = min(5, len(words(item)))
        own = grams(item, width) if width else set()
        for doc_id, text in rows:
            shared = len(own & grams(text, width)) if own else 0
            if own and 100 * shared >= containment * len(own):
                found[doc_id, item_id] = max(found.get((doc_id, item_id), (0, 0)), (shared / len(own), shared))
    return found


def test_both_searches_equal_brute_force(spark):
    rng = random.Random(8)
    items = [(k, prose(rng, rng.randrange(8, 60))) for k in range(25)]
    items += [(30, "One two"), (31, ""), (32, None), (33, "single"), (None, prose(rng, 12)), (34, items[0][1]), (34, items[0][1])]
    rows = awkward(rng)
    for place in range(60):
        text = prose(rng, rng.choice([20, 200, 3000]))
        item = (rng.choice(items)[1] or "").split(" ")
        if place % 2:
            item = [w.upper() if rng.random() < 0.3 else w for w in item]
            for _ in range(rng.randrange(0, 3)):
                item[rng.randrange(len(item))] = "changed"
            text = text + " " + " ".join(item) + " " + prose(rng, 10)
        rows.append((place, text))
    docs, tests = documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    expected = brute(rows, items)
    for index_values in (decontaminate.INDEX_VALUES, 0):
        got = decontaminate.contaminated(docs, tests, index_values=index_values).collect()
        assert {(r["doc_id"], r["item_id"]): (r["containment"], r["n_shared"]) for r in got} == expected
    assert len(expected) > 20
    hit = {doc_id for doc_id, _ in expected}
    kept = decontaminate.keep_clean(docs, tests)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(d) for d, _ in rows if d not in hit)


def test_rows_of_one_id_or_of_none_are_judged_alone(spark):
    rng = random.Random(4)
    item = prose(rng, 40).split(" ")
    whole, start, end = " ".join(item), " ".join(item[:24]), " ".join(item[16:])
    split = [(1, start), (1, end), (None, start), (None, end), (None, None)]
    hits = [(2, whole), (None, whole), (None, whole)]
    near = [(2, prose(rng, 50)), (None, prose(rng, 50))]
    tests = spark.createDataFrame([(7, whole)], "item_id long, text string")
    for index_values in (decontaminate.INDEX_VALUES, 0):
        assert decontaminate.contaminated(documents(spark, split), tests, index_values=index_values).count() == 0
        docs = documents(spark, split + hits + near)
        found = decontaminate.contaminated(docs, tests, index_values=index_values).collect()
        assert sorted(((r["doc_id"], r["n_shared"]) for r in found), key=str) == [(2, 36), (None, 36)]
        kept = decontaminate.keep_clean(docs, tests, index_values=index_values)
        assert kept.columns == docs.columns
        assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, split + near))


def test_empty_tables(spark):
    docs, tests = documents(spark, []), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0
    assert decontaminate.contaminated(documents(spark, ["a b c d e f"]), tests).count() == 0
    assert decontaminate.contaminated(documents(spark, ["a b c d e f"]), tests, index_values=-1).count() == 0
