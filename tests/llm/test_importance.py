import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

from airsift.llm import importance
from texts import awkward, documents, lowered, prose


def features(text):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    return len(own), [crc32(" ".join(own[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(own) - n + 1)]


def plain(rows, target, percent=5, least=20):
    found = [(doc_id, *features(text)) for doc_id, text in rows]
    s, t = Counter(b for _, _, own in found for b in own), Counter(b for text in target for b in features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for doc_id, count, own in found:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in own)
        score = None
        if doc_id is not None:
            head = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((head + 0.5) / 4294967296)))
        out.append([doc_id, count, len(own), weight, score])
    able = sorted((r for r in out if r[1] >= least and r[4] is not None), key=lambda r: (-r[4], r[0], -r[3], -r[2]))
    ranks = {id(r): place + 1 for place, r in enumerate(able[: percent * len(able) // 100])}
    return Counter((r[0], r[2], r[3], r[4], ranks.get(id(r))) for r in out)


def target_table(spark, texts):
    return spark.createDataFrame([(k, text, 1) for k, text in enumerate(texts)], "item_id long, text string, doc_id long")


def rows_and_target():
    rng = random.Random(6)
    target = [prose(rng, 40, 60) for _ in range(8)] + [None, "", "Él niño-99 [x]"]
    rows = list(enumerate(prose(rng, rng.randrange(1, 80), rng.choice([60, 400])) for _ in range(300)))
    rows += [(700, "Tab\tand.dots A1b2 é_É \x00 x\x7fy {z}`q"), (701, "9" * 5000), (702, "ÄÖ ǅ İ ß ſ K"), (703, "Mixed-Case, WORDS! " * 30)]
    return rows + awkward(rng), target


def test_equals_plain_version(spark):
    rows, target = rows_and_target()
    got = importance.resample(documents(spark, rows), target_table(spark, target)).collect()
    assert Counter(tuple(r) for r in got) == plain(rows, target)


def test_larger_share_is_drawn_by_the_same_order(spark):
    rows, target = rows_and_target()
    got = importance.resample(documents(spark, rows), target_table(spark, target), percent=60, least_words=3).collect()
    assert Counter(tuple(r) for r in got) == plain(rows, target, 60, 3)
    assert sorted(r["rank"] for r in got if r["rank"])[:3] == [1, 2, 3]


def test_ties_go_to_the_smaller_id(spark):
    """Without features every weight is 0; equal ids have equal noise."""
    rows = [(doc_id, " ".join(["same"] * 20)) for doc_id in [3, 3, 3, 8, 8] + list(range(100, 140))]
    got = importance.resample(documents(spark, rows), target_table(spark, []), percent=50).collect()
    assert Counter(tuple(r) for r in got) == plain(rows, [], 50)


def test_words_come_with_their_offsets():
    split = importance.splitter()
    text = importance.lowered("Ab-cd, É9 \x00z")
    found = split.pre_tokenize_str(text)
    assert [word for word, _ in found] == ["ab", "cd", "É9", "z"]
    assert all(text[a:b] == word for word, (a, b) in found)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert importance.resample(none, target_table(spark, ["some words"])).count() == 0
    got = importance.resample(documents(spark, [(1, "a b"), (2, None)]), target_table(spark, [])).collect()
    assert Counter(tuple(r) for r in got) == plain([(1, "a b"), (2, None)], [])
