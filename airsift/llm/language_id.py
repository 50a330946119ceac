"""Language identification: words first, character n-grams for words never seen.

Words are runs of letters, lower-cased. A word that was learned scores by its log frequency in each language. Of any
other word the longest n-grams of which at least one was learned score, by the mean over those learned: first four
characters, then three, two and one; n-grams know whether they begin or end the word. A word none of whose characters
was learned says nothing. A document's score in a language is the mean over its words.

The model is fitted on a bounded sample: about ``ROWS_PER_LANGUAGE`` labelled rows of each language, those with the
least hashed ids, or fewer where their texts would have over ``BYTES_PER_LANGUAGE`` bytes on average, or all languages'
over ``SAMPLE_BYTES``. At most ``MOST_LANGUAGES`` are learned, those with most labelled rows. Every word and n-gram found
there ``LEAST_COUNT`` times is learned, so a language keeps its own however many others there are; only counts above 0
are stored. Every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift.llm import textbatch as tb
from airsift.llm.store import small_batches

ROWS_PER_LANGUAGE = 1_000
# What the model on the driver grows with: texts of the sample by language and in all, and languages.
BYTES_PER_LANGUAGE, SAMPLE_BYTES = 16 << 20, 256 << 20
MOST_LANGUAGES = 1_000
LEAST_COUNT = 2
LONGEST_GRAM = 4
UNKNOWN = "und"

_HASHED = 1 << 30
_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
_KIND, _BEGINS, _ENDS = (np.uint64(k) for k in (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


class _Letters:
    """The words of a chunk as ranges of lower-cased code points."""

    def __init__(self, chunk: tb.Chunk, column: str = "text"):
        texts = [(t.as_py() or "").lower() for t in chunk.column(column)]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        bounds = np.append(0, np.cumsum([len(t) for t in texts]))
        inside = _LETTER[points]
        edge = np.ones(len(points) + 1, dtype=bool)
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[bounds] = True
        cuts = np.flatnonzero(edge)
        kept = inside[cuts[:-1]] if len(cuts) > 1 else np.zeros(0, dtype=bool)
        self.starts, self.ends = cuts[:-1][kept], cuts[1:][kept]
        self.owner = np.searchsorted(bounds, self.starts, side="right") - 1
        self.texts = chunk.texts
        self.sums = tb.FIRST.sums_of(tb.mix(points.astype(np.uint64) + _KIND))

    def words(self) -> np.ndarray:
        return tb.mix(tb.FIRST.between(self.sums, self.starts, self.ends))

    def grams(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """For the given words: the place in ``words`` and the key of each n-gram of ``size`` characters."""
        starts, ends = self.starts[words], self.ends[words]
        many = np.maximum(ends - starts - size + 1, 0)
        of = np.repeat(np.arange(len(words)), many)
        begin = np.repeat(starts, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        keys = tb.FIRST.between(self.sums, begin, begin + size) + np.uint64(int(_KIND) * size % 2**64)
        keys += _BEGINS * (begin == starts[of]).astype(np.uint64) + _ENDS * (begin + size == ends[of]).astype(np.uint64)
        return of, tb.mix(keys)


def _counted(languages: list[str]):
    position = {name: place for place, name in enumerate(languages)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in tb.chunks(batches):
            letters = _Letters(chunk)
            spoken = np.array([position[name] for name in chunk.column("lang").to_pylist()])[letters.owner]
            words = letters.words()
            parts = [(0, spoken, words)]
            for size in range(1, LONGEST_GRAM + 1):
                of, keys = letters.grams(np.arange(len(words)), size)
                parts.append((size, spoken[of], keys))
            for size, languages_of, keys in parts:
                frame = pd.DataFrame({"lang": languages_of, "key": tb.as_signed(keys)}).groupby(["lang", "key"]).size()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(frame), size)),
                        pa.array(frame.index.get_level_values(1).to_numpy()),
                        pa.array(frame.index.get_level_values(0).to_numpy().astype(np.int64)),
                        pa.array(frame.to_numpy()),
                    ],
                    names=["size", "key", "lang", "count"],
                )

    return rows


class _Table:
    """Log frequencies of sorted keys: what a language gives any known key, and what is added where it has the key."""

    def __init__(self, keys: np.ndarray, langs: np.ndarray, counts: np.ndarray, languages: int):
        order = np.lexsort((langs, keys))
        keys, self.langs, counts = keys[order], langs[order].astype(np.int32), counts[order]
        self.keys, first = np.unique(keys, return_index=True)
        self.bounds = np.append(first, len(keys))
        whole = np.bincount(self.langs, weights=counts, minlength=languages) + 0.5 * len(self.keys)
        self.unseen = np.log(0.5 / whole)
        self.more = np.log((counts + 0.5) / 0.5).astype(np.float32)

    def sums(self, of: np.ndarray, keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """For each of ``size`` owners: how many of its keys are known, and the sum of their logs by language."""
        languages = len(self.unseen)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        of, at = of[known], at[known]
        hits = np.bincount(of, minlength=size)
        many = self.bounds[at + 1] - self.bounds[at]
        entry = np.repeat(self.bounds[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        cells = np.repeat(of, many) * languages + self.langs[entry]
        more = np.bincount(cells, weights=self.more[entry], minlength=size * languages).reshape(size, languages)
        return hits, hits[:, None] * self.unseen + more


class Model:
    """Log frequencies by language of words (size 0) and n-grams."""

    def __init__(self, languages: list[str], entries: pd.DataFrame):
        self.languages = languages
        self.tables: dict[int, _Table] = {}
        for size, part in entries.groupby("size"):
            keys = part["key"].to_numpy(dtype=np.int64).view(np.uint64)
            self.tables[int(size)] = _Table(keys, part["lang"].to_numpy(dtype=np.int64), part["count"].to_numpy(dtype=np.int64), len(languages))

    def word_scores(self, letters: _Letters, words: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """A row of log frequencies for each of ``words``; NaN where nothing is known."""
        scores = np.full((len(words), len(self.languages)), np.nan, dtype=np.float32)
        open_words = np.arange(len(words))
        for size in (0, *range(LONGEST_GRAM, 0, -1)):
            if not len(open_words):
                break
            if size not in self.tables:
                continue
            of, found = letters.grams(words[open_words], size) if size else (open_words, keys)
            hits, sums = self.tables[size].sums(of, found, len(open_words))
            some = hits > 0
            scores[open_words[some]] = sums[some] / hits[some, None]
            open_words = open_words[~some]
        return scores


def _predicted(model: Model):
    count = len(model.languages)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in tb.chunks(batches):
            letters = _Letters(chunk)
            _, first, place = np.unique(letters.words(), return_index=True, return_inverse=True)
            scores = model.word_scores(letters, first, letters.words()[first]) if count else np.zeros((len(first), 0))
            known = ~np.isnan(scores).any(axis=1) if count else np.zeros(len(first), dtype=bool)
            use = known[place]
            n = np.bincount(letters.owner[use], minlength=chunk.texts)
            means = np.stack(
                [np.bincount(letters.owner[use], weights=scores[place[use], k], minlength=chunk.texts) / np.maximum(n, 1) for k in range(count)], axis=1
            ) if count else np.zeros((chunk.texts, 0))
            has_letters = np.bincount(letters.owner, minlength=chunk.texts) > 0
            names, shares = [], []
            for text in range(chunk.texts):
                if not has_letters[text] or not count:
                    names.append(UNKNOWN)
                    shares.append(0.0)
                    continue
                odds = np.exp((means[text] - means[text].max()) * min(n[text], 10))
                best = int(means[text].argmax())
                names.append(model.languages[best])
                shares.append(float(odds[best] / odds.sum()))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("held_out"), pa.array(names, pa.string()), pa.array(shares, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows


def _share(rows: int, size: int, languages: int) -> int:
    """How many of ``_HASHED`` values take a row into the sample, for a language of ``rows`` rows and ``size`` bytes."""
    most = min(BYTES_PER_LANGUAGE, SAMPLE_BYTES // languages)
    return min(_HASHED, _HASHED * ROWS_PER_LANGUAGE // rows, _HASHED * most // max(size, 1))


def fit(documents: DataFrame) -> Model:
    """A model of the languages in ``lang``, from rows that are not held out."""
    labelled = small_batches(documents).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    totals = labelled.groupBy("lang").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    totals = totals.orderBy(F.desc("rows"), "lang").limit(MOST_LANGUAGES).collect()
    languages = sorted(row["lang"] for row in totals)
    if not languages:
        return Model([], pd.DataFrame({"size": [], "key": [], "lang": [], "count": []}))
    shares = labelled.sparkSession.createDataFrame([(row["lang"], _share(row["rows"], row["bytes"], len(languages))) for row in totals], "lang string, share long")
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(_HASHED))
    # A row a language, MOST_LANGUAGES at most.
    sample = labelled.join(F.broadcast(shares), "lang").where(hashed < F.col("share")).select("text", "lang")
    counts = sample.mapInArrow(_counted(languages), "size long, key long, lang long, count long").groupBy("size", "key", "lang").agg(F.sum("count").alias("count"))
    entries = counts.where(F.col("count") >= LEAST_COUNT).select(F.col("size").cast("byte").alias("size"), "key", F.col("lang").cast("int").alias("lang"), "count")
    return Model(languages, entries.toPandas())


def identify(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred and score (the share of the best language, 0 to 1).

    A null text, or one without a letter, is ``und`` with score 0, as is every text if nothing could be learned. Equal
    scores go to the first language in order. Rows without an id are scored, not held out and not learned from; repeated
    rows are scored alike; an empty table gives no rows. ``lang`` and ``source`` are not read here.
    """
    model = model or fit(documents)
    docs = small_batches(documents).select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return docs.mapInArrow(_predicted(model), "doc_id long, held_out boolean, lang_pred string, score double")
