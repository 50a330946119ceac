import random
import warnings

import numpy as np
import pytest

from airsift.llm import mixing
from texts import awkward, documents, prose


def test_rates_are_the_least_squares_optimum(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.3, 0.3], 200)
    tokens = rng.integers(0, 500, 200)
    rows = [(k, 0, int(t), *map(float, q)) for k, (t, q) in enumerate(zip(tokens, p))]
    members = spark.createDataFrame(rows, "doc_id long, tag int, n_tokens long, p_a double, p_b double, p_c double")
    targets = {"a": 0.8, "b": 0.2, "c": 0.0}
    with pytest.warns(UserWarning, match="no rates were found"):
        rows = mixing.fitted_rates(members, targets).collect()
    got = {r["doc_id"]: r["rate"] for r in rows}
    assert {r["targets_met"] for r in rows} == {False} and rows[0]["residual"] > mixing.TOLERANCE
    w, scale = np.array([0.8, 0.2, 0.0]), np.array([0.8, 0.2, 0.05])
    share = tokens / tokens.sum()

    def cost(rate):
        e = (rate * share) @ p
        return ((e - w) ** 2 / scale).sum() / 2 + mixing.PENALTY / 2 * (share * (rate - 1) ** 2).sum()

    rate = np.ones(200)
    for _ in range(20_000):
        error = ((rate * share) @ p - w) / scale
        rate = np.maximum(0, rate - 0.04 * (p @ error + mixing.PENALTY * (rate - 1)))
    mine = np.array([got[k] for k in range(200)])
    assert (mine >= 0).all()
    assert cost(mine) <= cost(rate) * 1.02 + 1e-6
    assert np.abs((mine * share) @ p - w).max() < 0.06


def expected_shares(spark, p, tokens, targets):
    names = list(targets)
    rows = [(k, 0, int(t), *map(float, q)) for k, (t, q) in enumerate(zip(tokens, p))]
    members = spark.createDataFrame(rows, "doc_id long, tag int, n_tokens long, " + ", ".join(f"p_{n} double" for n in names))
    got = mixing.fitted_rates(members, targets).collect()
    assert all(r["rate"] >= 0 for r in got)
    return np.array([sum(r["rate"] * r["n_tokens"] * r[f"p_{n}"] for r in got) for n in names]) / sum(tokens)


@pytest.mark.parametrize("held, soft", [((0.95, 0.049, 0.001), 0), ((0.95, 0.0495, 0.0005), 0), ((0.05, 0.45, 0.5), 0), ((0.97, 0.029, 0.001), 0.004)])
def test_rare_domains_get_their_targets(spark, held, soft):
    rng = np.random.default_rng(1)
    own = np.repeat(np.eye(3), np.round(2000 * np.array(held)).astype(int), axis=0)
    p = (1 - soft) * own + soft * rng.dirichlet([1, 1, 1], len(own))
    targets = {"clean": 0.93, "toxic": 0.04, "junk": 0.03}
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        shares = expected_shares(spark, p, rng.integers(50, 60, len(p)), targets)
    assert np.abs(shares / np.array(list(targets.values())) - 1).max() < 1e-3


def test_targets_without_fitting_rates_are_reported(spark):
    with pytest.warns(UserWarning, match="no rates were found"):
        expected_shares(spark, [[0.5, 0.5]] * 4, [10] * 4, {"a": 0.9, "b": 0.1})
    # Of weight 0 and apart from the others: nothing.
    assert np.abs(expected_shares(spark, np.eye(3), [100, 1, 50], {"a": 0.5, "b": 0.5, "c": 0.0}) - [0.5, 0.5, 0]).max() < 1e-3


@pytest.mark.parametrize("weights", [(0.5, 0.3, 0.2), (0.86, 0.1, 0.04), (0.1, 0.1, 0.8)])
def test_rates_equal_plain_projected_gradient_and_stay_close_to_one(spark, weights):
    rng = np.random.default_rng(7)
    p = rng.dirichlet([0.25, 0.25, 0.25], 300)
    tokens = rng.integers(0, 400, 300)
    share, w = tokens / tokens.sum(), np.array(weights)
    rows = [(k, 0, int(t), *map(float, q)) for k, (t, q) in enumerate(zip(tokens, p))]
    members = spark.createDataFrame(rows, "doc_id long, tag long, n_tokens long, p_a double, p_b double, p_c double")
    got = mixing.fitted_rates(members, dict(zip("abc", weights))).collect()
    assert all(r["targets_met"] and r["residual"] <= mixing.TOLERANCE for r in got)
    mine = np.zeros(300)
    mine[[r["doc_id"] for r in got]] = [r["rate"] for r in got]
    rate, metric = np.ones(300), np.linalg.inv((p * share[:, None]).T @ p)
    while (np.abs((rate * share) @ p - w) > mixing.TOLERANCE * w).any():
        rate = np.maximum(0, rate - p @ metric @ ((rate * share) @ p - w))
    assert np.abs(mine - rate).max() < 1e-6
    # The closest of all rates that give the targets: multipliers at tight tolerance.
    multipliers, _, found = mixing._multipliers(members, list("abc"), w, float(tokens.sum()), 1e-9 * w, np.zeros(3))
    best = np.maximum(0, 1 + p @ multipliers)
    assert found and (share * (mine - 1) ** 2).sum() <= 1.1 * (share * (best - 1) ** 2).sum()


def plain_copies(rows):
    """A rate's floor, and one more for ids whose hash falls below the rest: between the two, and right on average."""
    return all(int(np.floor(r["rate"])) <= r["copies"] <= int(np.ceil(r["rate"])) for r in rows)


def corpus(spark):
    rng = random.Random(2)
    rows = [(k, prose(rng, rng.randrange(60, 120)) + (" horrid nasty" if k % 4 == 0 else " kind")) for k in range(200)]
    labelled = spark.createDataFrame([(k, "toxic" if k % 4 == 0 else "clean") for k in range(0, 200, 2)] + [(None, "clean"), (1, "other")], "doc_id long, domain string")
    return rows, awkward(rng), labelled


def test_mix(spark):
    rows, odd, labelled = corpus(spark)
    docs = documents(spark, rows + odd)
    targets = {"clean": 0.9, "toxic": 0.1}
    got = mixing.mix(docs, labelled, targets).collect()
    assert len(got) == docs.count()
    own = {r["doc_id"]: r for r in got}
    unseen = [k for k in range(1, 200, 2)] + [k for k in range(0, 200, 2)]
    assert all((own[k]["p_toxic"] > 0.5) == (k % 4 == 0) for k in unseen)
    for r in got:
        assert abs(r["p_clean"] + r["p_toxic"] - 1) < 1e-9 and r["rate"] >= 0
        assert r["copies"] in (int(np.floor(r["rate"])), int(np.floor(r["rate"])) + 1)
    assert plain_copies(got)
    assert own[900]["n_tokens"] == 0
    assert len({tuple(r) for r in got if r["doc_id"] == 913}) == 1
    total = sum(r["n_tokens"] for r in got)
    assert abs(sum(r["rate"] * r["n_tokens"] * r["p_toxic"] for r in got) / total - 0.1) < 0.05


def test_copies_join_their_documents(spark):
    rows, odd, labelled = corpus(spark)
    docs = documents(spark, rows + odd)
    targets = {"clean": 0.9, "toxic": 0.1}
    wanted = sorted((str(r["doc_id"]), r["copies"]) for r in mixing.mix(docs, labelled, targets).collect() if r["copies"])
    got = mixing.with_copies(docs, labelled, targets)
    assert got.columns == docs.columns + ["n_tokens", "rate", "copies"]
    assert sorted((str(r["doc_id"]), r["copies"]) for r in got.collect()) == wanted


def test_empty_tables(spark):
    _, _, labelled = corpus(spark)
    assert mixing.mix(documents(spark, []), labelled, {"clean": 1.0, "toxic": 1.0}).count() == 0
    got = mixing.mix(documents(spark, ["some text"]), labelled.limit(0), {"clean": 1.0, "toxic": 1.0}).collect()
    assert got[0]["p_clean"] == 0.5 and got[0]["copies"] >= 0
