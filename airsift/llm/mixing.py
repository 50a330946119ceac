"""Mixing to target weights with soft membership.

1. A softmax classifier, fitted on a labelled table, gives each document a probability for each domain. Its features
   are the presence of hashed words that tell the domains apart best, and shares of symbols, capitals and repeats.
2. Documents get nonnegative rates. A domain's expected tokens are the sum over documents of rate * tokens *
   probability; they shall be the target weights times all tokens. The rates come from projected-gradient least squares:
   from 1 on, each step moves all rates against the gradient of

       1/2 * error' * moments^-1 * error,   error = expected shares - weights,
       moments = mean over tokens of probability * probability'

   and sets negative ones to 0, until every domain is within ``TOLERANCE`` of its weight, relative to it. In this metric
   a whole step is always safe, and exact while no rate meets 0, so rates stay close to 1. A step is one distributed sum
   over all documents, one number a domain. If a target lies outside the probabilities that documents have for it, or
   the error stops falling, no rates give the targets: the rows say so
   (``targets_met``, ``residual``), and the rates are those that minimise

       1/2 * sum over domains of error^2 / weight  +  PENALTY/2 * mean over tokens of (rate - 1)^2

   with no divisor below ``LEAST_SCALE``: max(0, 1 + sum over domains of multiplier * probability), with multipliers
   from Newton steps.
3. A rate becomes a whole number of copies: its floor, and one more for documents whose hashed id falls below the rest.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift.llm import textbatch as tb
from airsift.llm.store import small_batches, stored

# Labelled rows the classifier is fitted on: those with the least hashed ids.
FIT_ROWS = 4_000
BUCKETS = 1 << 15
CHOSEN = 400
FIT_STEPS, FIT_RATE, FIT_PENALTY = 200, 0.05, 2e-3
PENALTY, LEAST_SCALE = 0.02, 0.05
TOLERANCE = 1e-4
# Gradient steps in which the error must fall by a tenth, else the targets are out of reach; and after so many the rates
# so far are stored, so that a plan holds no more steps than that.
STEPS_TO_FALL, STORE_STEPS = 40, 10
# Newton sums for the penalised rates; about ten are needed.
MOST_SUMS = 100

# Domains of the labels table and the share of tokens each shall have.
TARGETS = {"clean": 0.93, "toxic": 0.04, "junk": 0.03}

_SYMBOL, _UPPER = np.zeros(256, dtype=np.int64), np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>!")] = 1
_UPPER[65:91] = 1


def label_domain() -> Column:
    return F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")


def _presence(chunk: tb.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs, tokens of each text and shares that tell junk."""
    words = tb.Words(chunk, lower=True)
    values = words.values()
    buckets = (values >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    pairs = np.unique(words.text_of_each() * BUCKETS + buckets)
    distinct, _ = tb.distinct(words.text_of_each(), values)
    size = np.maximum(np.diff(chunk.bounds), 1)
    tokens = np.maximum(words.counts, 1)

    def share(table: np.ndarray) -> np.ndarray:
        running = np.append(0, np.cumsum(table[chunk.data]))
        return np.diff(running[chunk.bounds]) / size

    shares = np.stack(
        [np.minimum(5 * share(_SYMBOL), 1), np.minimum(3 * share(_UPPER), 1), 1 - np.bincount(distinct, minlength=chunk.texts) / tokens, words.counts < 50, np.ones(chunk.texts)],
        axis=1,
    )
    return pairs // BUCKETS, pairs % BUCKETS, words.counts, shares


class Classifier:
    """Softmax over the chosen buckets and the shares. Without domains' rows it knows nothing and says so evenly."""

    def __init__(self, domains: list[str], chosen: np.ndarray, weights: np.ndarray):
        self.domains, self.weights = domains, weights
        self.column = np.full(BUCKETS, -1, dtype=np.int64)
        self.column[chosen] = np.arange(len(chosen))

    def inputs(self, texts: np.ndarray, buckets: np.ndarray, shares: np.ndarray) -> np.ndarray:
        used = self.column[buckets]
        table = np.zeros((len(shares), int(self.column.max()) + 1))
        table[texts[used >= 0], used[used >= 0]] = 1
        return np.concatenate([table, shares], axis=1)

    def posteriors(self, inputs: np.ndarray) -> np.ndarray:
        scores = inputs @ self.weights
        scores -= scores.max(axis=1, keepdims=True)
        odds = np.exp(scores)
        return odds / odds.sum(axis=1, keepdims=True)

    @classmethod
    def fitted(cls, domains: list[str], labels: np.ndarray, texts: np.ndarray, buckets: np.ndarray, shares: np.ndarray) -> Classifier:
        width = shares.shape[1]
        if not len(labels):
            return cls(domains, np.zeros(0, dtype=np.int64), np.zeros((width, len(domains))))
        totals = np.bincount(labels, minlength=len(domains))
        counts = np.zeros((BUCKETS, len(domains)))
        np.add.at(counts, (buckets, labels[texts]), 1)
        expected = counts.sum(axis=1, keepdims=True) * totals / totals.sum()
        telling = (np.abs(counts - expected) / np.sqrt(expected + 1)).max(axis=1)
        chosen = np.sort(np.argsort(-telling, kind="stable")[:CHOSEN])
        model = cls(domains, chosen, np.zeros((len(chosen) + width, len(domains))))
        inputs = model.inputs(texts, buckets, shares)
        wanted = np.eye(len(domains))[labels]
        mean, spread = np.zeros_like(model.weights), np.zeros_like(model.weights)
        for step in range(1, FIT_STEPS + 1):
            gradient = inputs.T @ (wanted - model.posteriors(inputs)) / len(labels) - FIT_PENALTY * model.weights
            mean = 0.9 * mean + 0.1 * gradient
            spread = 0.99 * spread + 0.01 * gradient**2
            model.weights += FIT_RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        return model


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in tb.chunks(batches):
        texts, buckets, _, shares = _presence(chunk)
        bounds = np.searchsorted(texts, np.arange(chunk.texts + 1)).astype(np.int32)
        width = shares.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("rank"),
                chunk.column("domain"),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(buckets.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(np.arange(chunk.texts + 1, dtype=np.int32) * width), pa.array(shares.ravel())),
            ],
            names=["rank", "domain", "buckets", "shares"],
        )


def fit(documents: DataFrame, labelled: DataFrame, domains: list[str]) -> Classifier:
    """``labelled`` has doc_id and domain; rows of other domains are ignored, an id in several goes to the first in order."""
    rank = F.xxhash64("doc_id")
    known = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "domain").where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
    chosen = known.groupBy("doc_id").agg(F.min("domain").alias("domain")).orderBy(rank, "doc_id").limit(FIT_ROWS)
    chosen = chosen.select(F.col("doc_id").alias("labelled"), "domain", rank.alias("rank"))
    texts = small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["labelled"]).select("rank", "domain", "text")
    schema = "rank long, domain string, buckets array<int>, shares array<double>"
    rows = marked.mapInArrow(_fit_rows, schema).orderBy("rank", F.xxhash64("buckets")).limit(FIT_ROWS).toPandas()
    position = {name: place for place, name in enumerate(domains)}
    labels = np.array([position[name] for name in rows["domain"]], dtype=np.int64)
    sizes = [len(b) for b in rows["buckets"]]
    buckets = np.concatenate([np.asarray(b, dtype=np.int64) for b in rows["buckets"]]) if sizes else np.zeros(0, dtype=np.int64)
    shares = np.stack(rows["shares"].to_numpy()) if sizes else np.zeros((0, 5))
    return Classifier.fitted(domains, labels, np.repeat(np.arange(len(sizes)), sizes), buckets, shares)


def _memberships(model: Classifier):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in tb.chunks(batches):
            texts, buckets, tokens, shares = _presence(chunk)
            found = model.posteriors(model.inputs(texts, buckets, shares))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("tag"), pa.array(tokens.astype(np.int64)), *(pa.array(np.ascontiguousarray(column)) for column in found.T)],
                names=["doc_id", "tag", "n_tokens", *(f"p_{name}" for name in model.domains)],
            )

    return rows


def memberships(documents: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, tag (a 64-bit hash of the text), n_tokens and p_<domain> of every document."""
    texts = small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, tag long, n_tokens long, " + ", ".join(f"p_{name} double" for name in model.domains)
    return texts.withColumn("tag", F.xxhash64("text")).mapInArrow(_memberships(model), schema)


def _rate(names: list[str], multipliers: np.ndarray) -> Column:
    rate = F.lit(1.0)
    for name, value in zip(names, multipliers):
        rate = rate + F.col(f"p_{name}") * F.lit(float(value))
    return F.greatest(F.lit(0.0), rate)


def _multipliers(members: DataFrame, names: list[str], weights: np.ndarray, total: float, give: np.ndarray, multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Multipliers with expected share - weight + give * multiplier = 0 in every domain, the shares, and if they are found.

    They minimise the convex mean of rate^2 / 2 - weights * multipliers + give * multipliers^2 / 2.
    """
    pairs = [(a, b) for a in range(len(names)) for b in range(a, len(names))]

    def at(place: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        held = members.select("n_tokens", *(f"p_{name}" for name in names), _rate(names, place).alias("rate"))
        share = [F.col("n_tokens") * F.col(f"p_{name}") for name in names]
        sums = [F.sum(F.col("n_tokens") * F.col("rate") * F.col("rate")), *(F.sum(F.col("rate") * s) for s in share)]
        sums += [F.sum(F.when(F.col("rate") > 0, share[a] * F.col(f"p_{names[b]}"))) for a, b in pairs]
        found = np.array([v or 0.0 for v in held.agg(*(s.alias(f"s{k}") for k, s in enumerate(sums))).first()], dtype=np.float64) / total
        shares = found[1 : len(names) + 1]
        curve = np.diag(give).astype(np.float64)
        for (a, b), value in zip(pairs, found[len(names) + 1 :]):
            curve[a, b] += value
            curve[b, a] = curve[a, b]
        return found[0] / 2 - weights @ place + (give * place**2).sum() / 2, shares - weights + give * place, curve, shares

    enough = TOLERANCE / 10 * np.where(weights > 0, weights, LEAST_SCALE)
    value, slope, curve, shares = at(multipliers)
    sums, part, move = 1, 1.0, None
    while (np.abs(slope) > enough).any():
        if move is None:
            move, part = -np.linalg.solve(curve, slope), 1.0
        if sums == MOST_SUMS or part < 1e-9:
            return multipliers, shares, False
        ahead = at(multipliers + part * move)
        sums += 1
        if ahead[0] <= value + 1e-4 * part * (slope @ move) + 1e-13 * (1 + abs(value)):
            multipliers = multipliers + part * move
            value, slope, curve, shares = ahead
            move = None
        else:
            part /= 2
    return multipliers, shares, True


def _projected(members: DataFrame, names: list[str], weights: np.ndarray, total: float) -> tuple[DataFrame, float, int]:
    """``members`` with the rates of projected-gradient least squares, the largest error relative to its weight, and the steps."""
    share = {name: F.col("n_tokens") * F.col(f"p_{name}") for name in names}
    pairs = [(a, b) for a in range(len(names)) for b in range(a, len(names))]
    sums = [F.sum(share[names[a]] * F.col(f"p_{names[b]}")).alias(f"m{a}_{b}") for a, b in pairs]
    ends = [end(F.when(F.col("n_tokens") > 0, F.col(f"p_{name}"))).alias(f"{end.__name__}_{name}") for end in (F.min, F.max) for name in names]
    found = members.agg(*sums, *ends).first()
    moments = np.zeros((len(names), len(names)))
    for (a, b), value in zip(pairs, found):
        moments[a, b] = moments[b, a] = float(value or 0) / total
    low, high = (np.array([float(v or 0) for v in found[len(pairs) + k * len(names) :][: len(names)]]) for k in range(2))
    if (low > weights * (1 + TOLERANCE)).any() or (high < weights * (1 - TOLERANCE)).any():
        # Rates that meet all targets average the probabilities: no share is below the least or above the greatest of them.
        return members.withColumn("rate", F.lit(1.0)), float("inf"), 0
    metric = np.linalg.pinv(moments, hermitian=True)
    rates = members.withColumn("rate", F.lit(1.0))
    worst: list[float] = []
    while True:
        sums = rates.agg(*(F.sum(F.col("rate") * share[name]).alias(name) for name in names)).first()
        error = np.array([float(value or 0) for value in sums]) / total - weights
        worst.append(float((np.abs(error) / weights).max()))
        steps = len(worst) - 1
        if worst[-1] <= TOLERANCE or steps >= STEPS_TO_FALL and worst[-1] > 0.9 * worst[-1 - STEPS_TO_FALL]:
            return rates, worst[-1], steps
        move = F.col("rate")
        for name, value in zip(names, metric @ error):
            move = move - F.col(f"p_{name}") * F.lit(float(value))
        rates = rates.withColumn("rate", F.greatest(F.lit(0.0), move))
        if (steps + 1) % STORE_STEPS == 0:
            rates = stored(rates, "rates")


def fitted_rates(members: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``members`` (n_tokens, p_<domain>) with ``rate``, ``targets_met`` and ``residual`` (largest error relative to its weight).

    See the module's text for the rates. Targets are scaled to a sum of 1. A domain of weight 0 gets nothing if the
    documents without any share in it can give the other targets; else it is held down by the tokens it has, and its
    error counts in full. Without tokens all rates are 1 and the targets count as met.
    """
    names = list(targets)
    weights = np.array([targets[name] for name in names], dtype=np.float64)
    if not names or (weights < 0).any() or not weights.sum():
        raise ValueError("targets need weights of at least 0, one of them above")
    weights /= weights.sum()

    def told(rates: DataFrame, met: bool, residual: float) -> DataFrame:
        return rates.withColumns({"targets_met": F.lit(met), "residual": F.lit(float(residual))})

    total = float(members.agg(F.sum("n_tokens")).first()[0] or 0)
    if not total:
        return told(members.withColumn("rate", F.lit(1.0)), True, 0.0)
    wanted = [name for name, weight in zip(names, weights) if weight]
    unwanted = F.lit(False)
    for name, weight in zip(names, weights):
        if not weight:
            unwanted = unwanted | (F.col(f"p_{name}") > 0)
    rates, residual, _ = _projected(members.where(~unwanted), wanted, weights[weights > 0], total)
    if residual <= TOLERANCE:
        return told(rates.union(members.where(unwanted).withColumn("rate", F.lit(0.0))), True, residual)
    give = PENALTY * np.maximum(weights, LEAST_SCALE)
    multipliers, shares, found = _multipliers(members, names, weights, total, give, np.zeros(len(names)))
    said = ", ".join(f"{name} {share:.6f} for {weight:.6f}" for name, share, weight in zip(names, shares, weights))
    warnings.warn(f"no rates were found that give the targets; {'nearest' if found else 'last'} shares: {said}", stacklevel=2)
    residual = (np.abs(shares - weights) / np.where(weights > 0, weights, 1)).max()
    return told(members.withColumn("rate", _rate(names, multipliers)), False, residual)


def mix(documents: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, p_<domain>, rate (0 or more), targets_met, residual and copies (a whole number).

    Null and empty texts have no tokens; their rate moves with their probabilities, without effect on the totals. Rows
    without an id and repeated rows count like others; equal rows get equal copies. An empty table gives no rows; without
    labelled rows all domains are equally likely.
    """
    return _mixed(documents, labelled, targets or TARGETS).drop("tag")


def _mixed(documents: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    model = fit(documents, labelled, list(targets))
    rates = fitted_rates(stored(memberships(documents, model), "memberships"), targets)
    part = F.pmod(F.xxhash64("doc_id", "tag"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return rates.withColumn("copies", (F.floor("rate") + (part < F.col("rate") - F.floor("rate")).cast("int")).cast("long"))


def with_copies(documents: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The documents that have at least one copy in the mix, with n_tokens, rate and copies.

    Columns of these names in ``documents`` give way.
    """
    chosen = _mixed(documents, labelled, targets or TARGETS).where("copies > 0").groupBy("doc_id", "tag").agg(
        F.first("n_tokens").alias("n_tokens"), F.first("rate").alias("rate"), F.first("copies").alias("copies")
    )
    chosen = chosen.select(F.col("doc_id").alias("mixed_id"), F.col("tag").alias("mixed_tag"), "n_tokens", "rate", "copies")
    kept = documents.drop("n_tokens", "rate", "copies", "mixed_id", "mixed_tag")
    tag = F.xxhash64(kept["text"].cast("string"))
    joined = kept.join(chosen, kept["doc_id"].cast("long").eqNullSafe(chosen["mixed_id"]) & (tag == chosen["mixed_tag"]))
    return joined.drop("mixed_id", "mixed_tag")
