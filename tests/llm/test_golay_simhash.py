import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from airsift.llm import golay_simhash as golay
from texts import awkward, documents, lowered, prose, words


def plain_print(text, width=3):
    own = words(lowered(text))
    if not own:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(own[i : i + width]).encode(), 42) for i in range(max(1, len(own) - width + 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_classes(nodes, most=3):
    """Least node reachable over links of at most ``most`` bits, all pairs compared."""
    nodes = sorted(nodes)
    values = np.array(nodes, dtype=np.uint64)
    label = {}
    for start in nodes:
        if start in label:
            continue
        label[start], open_nodes = start, [start]
        while open_nodes:
            at = open_nodes.pop()
            for near in values[np.bitwise_count(values ^ np.uint64(at)) <= most].tolist():
                if near not in label:
                    label[near] = start
                    open_nodes.append(near)
    return label


def test_code_is_perfect_with_least_distance_seven():
    every = np.arange(1 << golay.CODE_BITS)
    tables, _ = golay._tables()
    codes = every[golay._remainders(every, tables) == 0]
    assert len(codes) == 4096 and min(np.bitwise_count(codes[1:])) == 7
    assert (golay.decode(codes) == np.arange(4096)).all()
    some = np.random.default_rng(1).integers(0, 1 << 23, 5000)
    assert np.bitwise_count(some ^ codes[golay.decode(some)]).max() <= 3


def test_words_at_one_bit_share_an_index():
    rng = np.random.default_rng(2)
    some = rng.integers(0, 1 << 23, 3000)
    other = some ^ (1 << rng.integers(0, 23, 3000))
    places, indices = golay.nearby(some)
    near = set(zip(places.tolist(), indices.tolist()))
    assert all((k, index) in near for k, index in enumerate(golay.decode(other).tolist()))
    assert set(np.bincount(places).tolist()) == {1, 6}


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_every_link_meets_in_both_directions(bits):
    rng = np.random.default_rng(bits)
    a = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    b = a.copy()
    for row in range(len(b)):
        for bit in rng.choice(64, bits, replace=False):
            b[row] ^= np.uint64(1 << int(bit))
    for one, two in ((a, b), (b, a)):
        met = np.zeros(len(a), dtype=bool)
        for (head, half), (other_head, other_half) in zip(golay._halves(one), golay._halves(two)):
            keys = head | golay.decode(half)
            places, indices = golay.nearby(other_half)
            near = set(zip(places.tolist(), (other_head[places] | indices).tolist()))
            met |= [(k, key) in near for k, key in enumerate(keys.tolist())]
        assert met.all()


def test_majority_equals_counting_bits():
    rng = np.random.default_rng(5)
    counts = [0, 1, 2, 3, 255, 256, 1000, 0, 510]
    hashes = rng.integers(0, 2**64, sum(counts), dtype=np.uint64)
    bounds = np.append(0, np.cumsum(counts))
    expected = []
    for first, last in zip(bounds, bounds[1:]):
        own = [int(h) for h in hashes[first:last]]
        expected.append(sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in own) > len(own)))
    assert golay.majority(hashes, bounds).tolist() == expected


def test_classes_equal_all_pairs(spark):
    """Crowded keys: chains of small steps, a ball around one point, two groups that only two members join."""
    rng = random.Random(3)
    nodes = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(30):
            for bit in rng.sample(range(64), rng.randrange(1, 5)):
                at ^= 1 << bit
            nodes.add(at)
    center, places = rng.getrandbits(64), rng.sample(range(64), 9)
    for _ in range(300):
        at = center
        for bit in rng.sample(places, rng.randrange(1, 9)):
            at ^= 1 << bit
        nodes.add(at)
    for at in list(nodes)[:40]:
        nodes.add(at ^ 0b111 << rng.randrange(61))
    frame = spark.createDataFrame([(int(np.uint64(n).view(np.int64)),) for n in nodes], "fp long")
    got = {int(np.int64(r["fp"]).view(np.uint64)): int(np.int64(r["label"]).view(np.uint64)) for r in golay.classes(frame).collect()}
    plain = plain_classes(nodes)
    sizes = Counter(plain.values())
    assert max(sizes.values()) > 50
    assert set(got) == {n for n in nodes if sizes[plain[n]] > 1}
    groups, expected = {}, {}
    for n in got:
        groups.setdefault(got[n], set()).add(n)
        expected.setdefault(plain[n], set()).add(n)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_link_between_the_largest_classes_of_two_keys(spark):
    """x and y meet under one key each, where the other only searches; a lesser neighbour of either is stored there."""
    rng = random.Random(6)
    nodes, linked = set(), 0
    while linked < 40:
        x = rng.getrandbits(64) | 0b11 << 24 | 0b11 << 28
        # Segment 0 is equal; one bit differs in the half of bits 32 to 39 and 48 to 63, two in the other half.
        y = x ^ 1 << rng.randrange(48, 64) ^ 1 << rng.randrange(40, 48) ^ 1 << rng.randrange(16, 24)
        mine, its = x ^ 0b11 << 24, y ^ 0b11 << 28
        heads, halves = zip(*golay._halves(np.array([x, y, mine, its], dtype=np.uint64)))
        own = golay.decode(halves[0])
        assert own[0] == own[2] and own[1] == own[3] and len(set(heads[0])) == 1
        linked += own[0] != own[1]
        nodes |= {x, y, mine, its}
    frame = spark.createDataFrame([(int(np.uint64(n).view(np.int64)),) for n in nodes], "fp long")
    labels = {int(np.int64(r["fp"]).view(np.uint64)): r["label"] for r in golay.classes(frame).collect()}
    plain = plain_classes(nodes)
    groups, expected = {}, {}
    for n in nodes:
        groups.setdefault(labels[n], set()).add(n)
        expected.setdefault(plain[n], set()).add(n)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_documents_equal_brute_force(spark):
    rng = random.Random(4)
    rows = awkward(rng)
    for group in range(12):
        base = prose(rng, rng.choice([8, 40, 200])).split()
        for copy in range(6):
            changed = list(base)
            for _ in range(rng.randrange(0, 3)):
                changed[rng.randrange(len(changed))] = f"other{rng.randrange(99)}"
            rows.append((1000 + 10 * group + copy, " ".join(changed).upper() if copy == 3 else "\n".join(changed)))
    got = Counter(tuple(r) for r in golay.near_duplicates(documents(spark, rows)).collect())
    prints = [plain_print(text) for _, text in rows]
    label = plain_classes(set(prints))
    least = {}
    for (doc_id, _), value in zip(rows, prints):
        if doc_id is not None:
            least[label[value]] = min(doc_id, least.get(label[value], doc_id))
    assert got == Counter((doc_id, f"{value:016x}", least.get(label[value])) for (doc_id, _), value in zip(rows, prints))
    assert least[label[0]] == 900


def test_empty_table_and_bound(spark):
    assert golay.near_duplicates(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        golay.classes(spark.createDataFrame([(1,)], "fp long"), 4)
