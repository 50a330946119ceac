"""Quality rules: counts of words, symbols and repeats, and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed word n-grams (single words and pairs): one counted on all trusted
documents, one on the whole corpus, with ``SMOOTHING`` added to a bucket's count among trusted documents and to the
count expected there from the corpus, so that rare buckets say little. A document's score is the mean over its n-grams
of log(trusted / corpus), so long and short texts compare. A document is kept if no count rule fails and its score is at
least the threshold; nothing is drawn at random.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsift.llm import textbatch as tb
from airsift.llm.store import documents_of, small_batches, small_list, stored

BUCKETS = 1 << 16
SMOOTHING = 10.0
THRESHOLD = -0.08
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_SYMBOLS = np.zeros(256, dtype=np.int64)
_SYMBOLS[list(b"#*$%&|<>")] = 1
_STARTS_CHARACTER = ((np.arange(256) & 0xC0) != 0x80).astype(np.int64)


def _running(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=out[1:])
    return out


def _between(running: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(running[bounds])


def _bucket_of(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _grams(words: tb.Words, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every single word and every pair."""
    texts, pairs = tb.windows(words, values, 2, short_whole=False)
    return np.concatenate([words.text_of_each(), texts]), _bucket_of(np.concatenate([tb.mix(values), pairs]))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, BUCKETS), dtype=np.int64)
    for chunk in tb.chunks(batches):
        words = tb.Words(chunk, lower=False)
        texts, buckets = _grams(words, words.values())
        trusted = chunk.column("trusted").to_numpy(zero_copy_only=False)
        totals[0] += np.bincount(buckets[trusted[texts]], minlength=BUCKETS)
        totals[1] += np.bincount(buckets, minlength=BUCKETS)
    cells = np.flatnonzero(totals[1])
    yield pa.RecordBatch.from_arrays(
        [pa.array(cells), pa.array(totals[0][cells]), pa.array(totals[1][cells])], names=["bucket", "trusted", "corpus"]
    )


def log_ratios(documents: DataFrame, trusted: DataFrame) -> np.ndarray:
    """log(trusted / corpus) of each bucket; ``trusted`` has the doc_id of documents known to be good."""
    chosen = stored(trusted.select(F.col("doc_id").cast("long").alias("trusted_id")).where("trusted_id is not null").distinct(), "trusted")
    side = F.broadcast(chosen) if small_list(chosen.count()) else chosen
    docs = documents_of(documents)
    marked = docs.join(side, F.col("doc_id") == F.col("trusted_id"), "left").select("text", F.col("trusted_id").isNotNull().alias("trusted"))
    sums = marked.mapInArrow(_counts, "bucket long, trusted long, corpus long").groupBy("bucket").agg(F.sum("trusted").alias("trusted"), F.sum("corpus").alias("corpus"))
    found = sums.toPandas()  # at most BUCKETS rows
    counts = np.zeros((2, BUCKETS))
    counts[:, found["bucket"].to_numpy(dtype=np.int64)] = found[["trusted", "corpus"]].to_numpy(dtype=np.float64).T
    if not counts[0].sum():
        return np.zeros(BUCKETS)
    expected = counts[1] * (counts[0].sum() / counts[1].sum())
    return np.log((counts[0] + SMOOTHING) / (expected + SMOOTHING))


def _repeat_words(words: tb.Words, values: np.ndarray) -> np.ndarray:
    """Per text, words inside three-word windows that the text holds twice or more."""
    total = len(values)
    if total < 3:
        return np.zeros(words.texts, dtype=np.int64)
    owner = words.text_of_each()
    at = np.flatnonzero(owner[:-2] == owner[2:])
    _, found = tb.windows(words, values, 3, short_whole=False)
    order = np.lexsort((found, owner[at]))
    same = (found[order][1:] == found[order][:-1]) & (owner[at][order][1:] == owner[at][order][:-1])
    often = np.zeros(len(at), dtype=bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    inside = np.zeros(total, dtype=np.int64)
    for shift in range(3):
        inside[at[often] + shift] = 1
    return _between(_running(inside), words.ranges)


def _repeat_lines(chunk: tb.Chunk, words: tb.Words) -> np.ndarray:
    """Per text, lines with a word that equal an earlier line."""
    breaks = np.flatnonzero(chunk.data == 10)
    starts = np.union1d(chunk.bounds[:-1][np.diff(chunk.bounds) > 0], breaks + 1)
    starts = starts[starts < len(chunk.data)]
    ends = np.append(starts[1:], len(chunk.data))[: len(starts)]
    owner = np.searchsorted(chunk.bounds, starts, side="right") - 1
    ends = np.where(chunk.data[ends - 1] == 10, ends - 1, ends)
    begun = np.searchsorted(words.starts, ends) - np.searchsorted(words.starts, starts)
    kept = begun > 0
    starts, ends, owner = starts[kept], ends[kept], owner[kept]
    values = tb.mix(tb.FIRST.between(tb.FIRST.sums(chunk.data), starts, ends) + (ends - starts).astype(np.uint64))
    texts, _ = tb.distinct(owner, values)
    return np.bincount(owner, minlength=chunk.texts) - np.bincount(texts, minlength=chunk.texts)


def _judged(ratios: np.ndarray, threshold: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in tb.chunks(batches):
            words = tb.Words(chunk, lower=False)
            values = words.values()
            texts, buckets = _grams(words, values)
            grams = np.bincount(texts, minlength=chunk.texts)
            score = np.bincount(texts, weights=ratios[buckets], minlength=chunk.texts) / np.maximum(grams, 1)
            characters = _running(_STARTS_CHARACTER[chunk.data])
            repeats = _repeat_words(words, values)
            failed = (words.counts < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words.counts)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(_between(_running(characters[words.ends] - characters[words.starts]), words.ranges)),
                    pa.array(_between(_running(_SYMBOLS[chunk.data]), chunk.bounds)),
                    pa.array(_repeat_lines(chunk, words).astype(np.int64)),
                    pa.array(repeats),
                    pa.array(failed),
                    pa.array(~failed & (score >= threshold)),
                    pa.array(score),
                ],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio"],
            )

    return rows


def quality(documents: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept and log_ratio.

    Null texts are empty; an empty text has no words, fails and has ratio 0. Without trusted documents every ratio is
    0 and the counts alone decide. Rows without an id and repeated rows are judged like others; an empty table gives
    no rows.
    """
    ratios = log_ratios(documents, trusted)
    return documents_of(documents).mapInArrow(
        _judged(ratios, threshold),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, log_ratio double",
    )


def trusted_documents(labels: DataFrame) -> DataFrame:
    """The ids labelled good and never bad: of several labels the worst counts; missing labels and ids count for nothing."""
    known = labels.where("doc_id is not null and quality is not null")
    return known.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that ``quality`` keeps, unchanged, whatever columns they have; every row is judged by its own text.

    Null and empty texts have no words and go. Rows without an id and repeated rows are judged like others, an empty table
    stays empty, and without labels the counts alone decide.
    """
    spark = documents.sparkSession
    ratios = log_ratios(documents, trusted_documents(labels))
    judge = _judged(ratios, THRESHOLD)
    columns = small_batches(documents).columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = pa.concat_arrays([pa.array([], pa.bool_())] + [r.column(7) for r in judge(iter([batch.select(["doc_id", "text"])]))])
            yield batch.filter(kept).select(columns)

    return documents.mapInArrow(rows, documents.schema)
