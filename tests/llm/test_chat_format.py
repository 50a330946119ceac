import random
import re

import pytest
from pyspark.sql.functions import spark_partition_id

from airsift.llm import chat_format
from airsift.llm.chat_format import CHOICES, FINAL, INSERT, MERGE, RELABEL, STATES

SCHEMA = "conv_id long, turn long, role string, text string, part long, cost double"


def brute(roles):
    """The least cost over all sequences of choices."""
    prices = {"append": 0.0, "merge": MERGE, "insert": INSERT}

    def rest(place, state):
        if place == len(roles):
            return FINAL[state]
        return min(prices[way] + RELABEL * (STATES[to] != roles[place]) + rest(place + 1, to) for start, to, way in CHOICES if start == state)

    return rest(0, 0)


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    rows = []
    for conv in range(80):
        for turn in range(rng.choice([1, 2, 3, 4, 5, 30])):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice(["hi", "", None, "a\nb", f"t{turn}"])))
    rows += [(99, turn, rng.choice(["user", "assistant", "system"]), "x" * 50) for turn in range(500)]
    rows += [(100, 1, "user", "tie"), (100, 1, "assistant", "tie"), (100, None, "system", "first"), (100, 1, "user", "tie")]
    rows += [(None, 0, "user", "no id"), (None, 1, "user", "no id")]
    return [(*row, 1, 2.0) for row in rows]


def ordered(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_least_cost_and_legal_turns(spark, turns):
    rows = chat_format.repair(spark.createDataFrame(turns, SCHEMA), 3).collect()
    assert len(rows) == len(turns)
    by_conv = {}
    for row in rows:
        by_conv.setdefault(row["conv_id"], []).append(row)
    for own in by_conv.values():
        own.sort(key=lambda r: (r["turn"] is not None, r["turn"], r["role"] is not None, r["role"] or ""))
        heads = re.findall(r"<\|(system|user|assistant)\|>", "".join(r["rendered"] for r in own))
        assert re.fullmatch("s?(ua)*", "".join(h[0] for h in heads))
        if len(own) < 6:
            assert sum(r["cost"] for r in own) == pytest.approx(brute([r["role"] for r in own]))


def test_parts_do_not_matter(spark, turns):
    table = spark.createDataFrame(turns, SCHEMA)
    one = ordered(chat_format.repair(table, 1))
    assert ordered(chat_format.repair(table, 4)) == one
    assert ordered(chat_format.repair(table, 40)) == one


def test_repairs(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (2, 0, "assistant", "d"), (3, 0, "system", "s"), (3, 1, "user", "u")]
    got = sorted(chat_format.repair(spark.createDataFrame([(*r, 0, 0.0) for r in rows], SCHEMA)).collect())
    assert [r["action"] for r in got] == ["keep", "merge", "keep", "insert user", "keep", "add assistant"]
    assert "".join(r["rendered"] for r in got[:3]) == "<|user|>\na\nb<|end|>\n<|assistant|>\nc<|end|>\n"
    assert got[3]["rendered"] == "<|user|>\n<|end|>\n<|assistant|>\nd<|end|>\n"
    assert got[5]["rendered"].endswith("u<|end|>\n<|assistant|>\n<|end|>\n")


def test_empty(spark):
    assert chat_format.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_rows_lie_in_several_parts_and_long_texts_make_more(spark, monkeypatch):
    rows = [(7, 1, "user", "again", 1, 2.0)] * 4000 + [(8, turn, "assistant", "y" * 3000, 1, 2.0) for turn in range(200)]
    rows += [(9, 1, "user", "z" * 100 + end, 1, 2.0) for end in ("b", "a", "", "a")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    one = chat_format.repair(table, 1)
    got = chat_format.repair(table, 8)
    assert ordered(got) == ordered(one)
    assert got.where("conv_id = 7").select(spark_partition_id()).distinct().count() > 1
    assert one.where("conv_id = 7").agg({"cost": "sum"}).first()[0] == 3998 * MERGE + RELABEL
    monkeypatch.setattr(chat_format, "PART_BYTES", 10_000)
    assert chat_format._parts(table) == -(-sum(len(row[3]) for row in rows) // 10_000)
