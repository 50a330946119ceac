"""Line quality by a linear-chain conditional random field, and document quality from its marginals.

Each line with a word is good or bad. Its features are counts and shares of the line and of the lines before and
after it; the chain has a weight for each pair of neighbouring labels. Training takes the document's label for all of
its lines. Forward and backward sums give each line's probability of being good, and a document's score is their mean
weighted by line length.

The field is fitted on a bounded sample: of the ``FIT_ROWS`` labelled texts with the least hashed ids, whole texts in that
order until ``FIT_LINES`` lines are reached. Texts that share an id are chains of their own, equal rows count once. Every
document is scored in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift.llm import textbatch as tb
from airsift.llm.store import small_batches, stored

FIT_ROWS = 4_000
FIT_LINES = 200_000
GOOD_FROM = 0.7
STEPS, RATE, PENALTY = 150, 0.1, 1e-3

_UPPER, _LOWER, _DIGIT, _MARK, _SYMBOL, _END = (np.zeros(256, dtype=np.int64) for _ in range(6))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = 1
_MARK[list(b".,;:!?")] = 1
_SYMBOL[list(b"#*$%&|<>{}[]=_~^\\/@")] = 1
_END[list(b".!?")] = 1
_STARTS = ((np.arange(256) & 0xC0) != 0x80).astype(np.int64)

FEATURES = 14


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


class Lines:
    """The lines with a word of a chunk: text of each, length in code points, and features."""

    def __init__(self, chunk: tb.Chunk):
        data = chunk.data
        words = tb.Words(chunk, lower=False)
        breaks = np.flatnonzero(data == 10)
        starts = np.union1d(chunk.bounds[:-1][np.diff(chunk.bounds) > 0], breaks + 1)
        starts = starts[starts < len(data)]
        ends = np.append(starts[1:], len(data))[: len(starts)]
        first, last = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
        kept = last > first
        starts, ends, first, last = starts[kept], ends[kept], first[kept], last[kept]
        self.owner = np.searchsorted(chunk.bounds, starts, side="right") - 1
        self.texts = chunk.texts

        def share(table: np.ndarray) -> np.ndarray:
            running = np.append(0, np.cumsum(table[data]))
            return running[ends] - running[starts]

        self.length = np.maximum(share(_STARTS), 1)
        n_words = last - first
        values = words.values()
        sums = tb.FIRST.sums(data)
        line_values = tb.mix(tb.FIRST.between(sums, words.starts[first], words.ends[last - 1]))
        seen_lines = self._again(self.owner, line_values)
        seen_words = self._again(words.text_of_each(), values)
        owner, triples = tb.windows(words, values, 3, short_whole=False)
        seen_triples = np.zeros(len(values), dtype=np.int64)
        if len(triples):
            whole = words.text_of_each()
            at = np.flatnonzero(whole[:-2] == whole[2:])
            seen_triples[at] = self._again(owner, triples)

        def per_word(marks: np.ndarray) -> np.ndarray:
            running = np.append(0, np.cumsum(marks))
            return (running[last] - running[first]) / n_words

        text_words = words.counts[self.owner]
        upper, lower = share(_UPPER), share(_LOWER)
        own = np.stack(
            [
                np.log1p(self.length) / 5,
                np.log1p(n_words) / 4,
                self.length / n_words / 10,
                upper / self.length,
                upper > lower,
                np.minimum(5 * share(_DIGIT) / self.length, 1),
                np.minimum(5 * share(_MARK) / self.length, 1),
                np.minimum(5 * share(_SYMBOL) / self.length, 1),
                share(_SYMBOL) > n_words,
                _END[data[words.ends[last - 1] - 1]],
                seen_lines,
                per_word(seen_words),
                per_word(seen_triples),
                text_words < 50,
            ],
            axis=1,
        ).astype(np.float64) if len(starts) else np.zeros((0, FEATURES))
        before, after = np.zeros_like(own), np.zeros_like(own)
        if len(own):
            same = (self.owner[1:] == self.owner[:-1])[:, None]
            before[1:] = own[:-1] * same
            after[:-1] = own[1:] * same
        self.features = np.concatenate([own, before, after, np.ones((len(own), 1))], axis=1)

    @staticmethod
    def _again(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
        """1 where the same value came earlier in the same text."""
        order = np.lexsort((values, owner))
        marks = np.zeros(len(values), dtype=np.int64)
        same = (values[order][1:] == values[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        marks[order[1:][same]] = 1
        return marks


class Chains:
    """Lines of several texts, laid out so that all texts are walked at once, longest first."""

    def __init__(self, owner: np.ndarray, texts: int):
        counts = np.bincount(owner, minlength=texts)
        begins = np.append(0, np.cumsum(counts))[:-1]
        order = np.argsort(-counts, kind="stable")
        counts, begins = counts[order], begins[order]
        depth = int(counts[0]) if len(counts) else 0
        open_texts = np.searchsorted(-counts, -np.arange(depth), side="left")
        self.steps = [begins[:open_] + step for step, open_ in enumerate(open_texts)]

    def marginals(self, scores: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line, and the expected number of each pair of neighbouring labels."""
        lines = len(scores)
        emit = np.stack([np.zeros(lines), scores], axis=1)
        forward, backward = np.zeros((lines, 2)), np.zeros((lines, 2))
        for step, rows in enumerate(self.steps):
            forward[rows] = emit[rows]
            if step:
                came = forward[self.steps[step - 1][: len(rows)]][:, :, None] + pairs
                forward[rows] += np.logaddexp(came[:, 0], came[:, 1])
        for step in range(len(self.steps) - 2, -1, -1):
            after = self.steps[step + 1]
            rows = self.steps[step][: len(after)]
            goes = (emit[after] + backward[after])[:, None, :] + pairs
            backward[rows] = np.logaddexp(goes[:, :, 0], goes[:, :, 1])
        total = forward + backward
        good = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -700, 700)))
        expected = np.zeros((2, 2))
        for step in range(1, len(self.steps)):
            rows = self.steps[step]
            before = self.steps[step - 1][: len(rows)]
            joint = forward[before][:, :, None] + pairs + (emit[rows] + backward[rows])[:, None, :]
            joint -= np.logaddexp(total[rows][:, 0], total[rows][:, 1])[:, None, None]
            expected += np.exp(joint).sum(axis=0)
        return good, expected


class Field:
    def __init__(self, weights: np.ndarray, pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs

    @classmethod
    def fitted(cls, owner: np.ndarray, features: np.ndarray, labels: np.ndarray, texts: int) -> Field:
        """Full-batch gradient ascent with adaptive steps; ``labels`` are 0 or 1 for each line."""
        parameters = np.zeros(features.shape[1] + 4)
        if not len(labels):
            return cls(parameters[:-4], parameters[-4:].reshape(2, 2))
        chains = Chains(owner, texts)
        near = owner[1:] == owner[:-1]
        observed = np.zeros((2, 2))
        np.add.at(observed, (labels[:-1][near], labels[1:][near]), 1)
        mean, spread = np.zeros_like(parameters), np.zeros_like(parameters)
        for step in range(1, STEPS + 1):
            good, expected = chains.marginals(features @ parameters[:-4], parameters[-4:].reshape(2, 2))
            gradient = np.append(features.T @ (labels - good), (observed - expected).ravel()) / len(labels) - PENALTY * parameters
            mean = 0.9 * mean + 0.1 * gradient
            spread = 0.99 * spread + 0.01 * gradient**2
            parameters += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        return cls(parameters[:-4], parameters[-4:].reshape(2, 2))

    def score(self, lines: Lines) -> np.ndarray:
        """Per text the mean probability of good, by length; of texts without a line that of a line of which nothing is known."""
        good, _ = Chains(lines.owner, lines.texts).marginals(lines.features @ self.weights, self.pairs)
        weight = np.bincount(lines.owner, weights=lines.length, minlength=lines.texts)
        mass = np.bincount(lines.owner, weights=lines.length * good, minlength=lines.texts)
        nothing = np.append(np.zeros(len(self.weights) - 1), 1.0)
        nothing[FEATURES - 1] = 1.0  # as short as can be
        blank = 1 / (1 + np.exp(-np.clip(self.weights @ nothing, -700, 700)))
        return np.where(weight > 0, mass / np.maximum(weight, 1), blank)


def _line_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in tb.chunks(batches):
        counts = np.bincount(Lines(chunk).owner, minlength=chunk.texts)
        yield pa.RecordBatch.from_arrays([chunk.column("rank"), chunk.column("tag"), pa.array(counts)], names=["rank", "tag", "lines"])


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in tb.chunks(batches):
        lines = Lines(chunk)
        at = pa.array(lines.owner)
        number = np.arange(len(lines.owner)) - np.searchsorted(lines.owner, lines.owner)
        width = lines.features.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("rank").take(at),
                chunk.column("tag").take(at),
                pa.array(number),
                chunk.column("quality").take(at),
                pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * width), pa.array(lines.features.ravel())),
            ],
            names=["rank", "tag", "line", "quality", "features"],
        )


def sample_lines(documents: DataFrame, labels: DataFrame, most_rows: int = FIT_ROWS, most_lines: int = FIT_LINES):
    """The lines (rank, tag, line, quality, features) of the sample, in order, as a pandas frame.

    Labelled rows that are not held out; conflicting labels of one id count as bad. ``tag`` tells the texts of an id apart.
    A text is taken whole or, if it would pass ``most_lines``, passed over.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    rank = F.xxhash64("doc_id")
    chosen = known.orderBy(rank, "doc_id").limit(most_rows).select(F.col("doc_id").alias("labelled"), "quality", rank.alias("rank"))
    texts = small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["labelled"]).select("rank", F.xxhash64("text").alias("tag"), "quality", "text")
    marked = stored(marked, "labelled-texts").dropDuplicates(["rank", "tag"])
    counts = marked.mapInArrow(_line_counts, "rank long, tag long, lines long").where("lines > 0")
    taken, total = [], 0
    for row in counts.orderBy("rank", "tag").limit(most_rows).collect():
        if total + row["lines"] <= most_lines:
            taken.append((row["rank"], row["tag"]))
            total += row["lines"]
    whole = marked.join(F.broadcast(marked.sparkSession.createDataFrame(taken, "rank long, tag long")), ["rank", "tag"])
    rows = whole.mapInArrow(_line_rows, "rank long, tag long, line long, quality int, features array<double>")
    return rows.orderBy("rank", "tag", "line").toPandas()


def fit(documents: DataFrame, labels: DataFrame) -> Field:
    """A field from ``sample_lines``."""
    lines = sample_lines(documents, labels)
    if not len(lines):
        return Field(np.zeros(3 * FEATURES + 1), np.zeros((2, 2)))
    features = np.stack(lines["features"].to_numpy())
    owner = np.cumsum(lines["line"].to_numpy() == 0) - 1
    return Field.fitted(owner, features, lines["quality"].to_numpy(dtype=np.int64), int(owner[-1]) + 1)


def _scored(field: Field):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in tb.chunks(batches):
            score = field.score(Lines(chunk))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("held_out"), pa.array(score), pa.array((score >= GOOD_FROM).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return rows


def classify(documents: DataFrame, labels: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score (higher: label 1 likelier) and predicted (1 from 0.7 on).

    Null texts are empty. A text without a word has no line; its score is that of a line of which nothing is known.
    Without labels every score is 0.5. Rows without an id are scored, not held out and not learned from; repeated rows
    are scored alike; an empty table gives no rows. Labels, lang, source and doc_id take no part in a score.
    """
    field = field or fit(documents, labels)
    docs = small_batches(documents).select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return docs.mapInArrow(_scored(field), "doc_id long, held_out boolean, score double, predicted int")
