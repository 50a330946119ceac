"""Benchmark decontamination: which test items stand inside which documents.

An item's set holds its distinct word shingles (words without ASCII white space, A-Z lower-cased), five words wide, or
as wide as the whole item if it is shorter. An item is found in a document that holds at least ``containment`` percent
of its shingles.

Symmetric MinHash bands cannot see a 30-word item in a text of 20,000 words (a similarity near 0.001), so the sketch
is one-sided: items are partitioned by size, and of each item its least hashed shingles are kept, one more than may be
missing. A document that reaches the containment holds at least one of them, whatever its length; a size class is
searched only in documents with enough windows for it. Candidates are then confirmed by exact counts of shared
shingles.

Items are few and short against the corpus: while their sets are below ``INDEX_VALUES`` they travel with the tasks and
documents are read once, without a shuffle. Of a larger benchmark the sketches travel as a Bloom filter of ``FILTER_BYTES``
at most, and only windows that pass it leave the task: they are joined with the sketches, by size class as above, to
candidate pairs, and those with the shingles of both sides. Results are the same. Each text is judged alone, also where
several rows share an id or have none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift.llm import textbatch as tb
from airsift.llm.store import documents_of, only_ids, stored

CONTAINMENT = 80
WIDTH = 5
# Shingles of all items that may be sent to every task: 16 MB.
INDEX_VALUES = 2_000_000

# Bits a sketch value takes in the filter, marks it sets there, and the filter's largest size. Beyond it more windows pass.
FILTER_BITS, FILTER_MARKS, FILTER_BYTES = 16, 4, 32 << 20

RESULT = "doc_id long, tag long, item_id long, n_item_shingles long, n_shared long, containment double"
WINDOWS = "doc_id long, tag long, n_windows long, width long, shingle long"


def sketch_size(sizes: np.ndarray, containment: int) -> np.ndarray:
    """One more than the shingles that an item may lack."""
    return sizes - -(-containment * sizes // 100) + 1


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in tb.chunks(batches):
        words = tb.Words(chunk, lower=True)
        values = words.values()
        wide = np.minimum(words.counts, WIDTH)
        for width in range(1, WIDTH + 1):
            texts, found = tb.distinct(*tb.windows(words, values, width, short_whole=False))
            own = wide[texts] == width
            texts, found = texts[own], found[own]
            rows = np.flatnonzero(wide == width)
            bounds = np.searchsorted(texts, np.append(rows, chunk.texts))
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("item_id").take(pa.array(rows)),
                    pa.array(np.full(len(rows), width)),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    tb.long_lists(bounds, found),
                ],
                names=["item_id", "width", "n", "shingles"],
            )


def item_sets(benchmark: DataFrame) -> DataFrame:
    """item_id, width, n and shingles of each different item; items without a word have none and are left out."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(_items, "item_id long, width long, n long, shingles array<long>").where("n > 0").distinct()


class _SizeClass:
    """Items of one width and size class: their sketches, sorted, with the item of each value."""

    def __init__(self, width: int, items: list[int], sets: list[np.ndarray], containment: int):
        self.width = width
        sizes = np.array([len(sets[item]) for item in items])
        self.fewest = int((-(-containment * sizes // 100)).min())
        kept = [sets[item][np.argsort(tb.mix(sets[item]))[:size]] for item, size in zip(items, sketch_size(sizes, containment))]
        values, owners = np.concatenate(kept), np.repeat(items, [len(k) for k in kept])
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], owners[order]

    def candidates(self, texts: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Rows (text, item) that share a sketch value; ``texts`` and ``values`` are all windows of this width."""
        first = np.searchsorted(self.values, values)
        hit = self.values[np.minimum(first, len(self.values) - 1)] == values
        texts, values, first = texts[hit], values[hit], first[hit]
        many = np.searchsorted(self.values, values, side="right") - first
        at = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.unique(np.stack([np.repeat(texts, many), self.owners[at]], axis=1), axis=0)


def _searcher(items, containment: int):  # items: the rows of ``item_sets`` as a pandas frame
    sets = [np.sort(np.asarray(s, dtype=np.int64).view(np.uint64)) for s in items["shingles"]]
    ids = pa.array(items["item_id"], type=pa.int64(), from_pandas=True)
    sizes = items["n"].to_numpy()
    grouped: dict[tuple[int, int], list[int]] = {}
    for row, (width, size) in enumerate(zip(items["width"], sizes)):
        grouped.setdefault((int(width), int(size).bit_length()), []).append(row)
    classes = [_SizeClass(width, rows, sets, containment) for (width, _), rows in sorted(grouped.items())]
    widths = sorted({c.width for c in classes})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in tb.chunks(batches):
            words = tb.Words(chunk, lower=True)
            values = words.values()
            found: list[tuple[int, int, int]] = []
            for width in widths:
                texts, shingles = tb.windows(words, values, width, short_whole=False)
                per_text = np.bincount(texts, minlength=chunk.texts)
                bounds = np.append(0, np.cumsum(per_text))
                own: dict[int, np.ndarray] = {}
                for size_class in (c for c in classes if c.width == width):
                    enough = (per_text >= size_class.fewest)[texts]
                    for text, item in size_class.candidates(texts[enough], shingles[enough]):
                        if text not in own:
                            own[text] = np.unique(shingles[bounds[text] : bounds[text + 1]])
                        shared = int(np.isin(sets[item], own[text]).sum())
                        if 100 * shared >= containment * sizes[item]:
                            found.append((text, item, shared))
            if found:
                texts, hits, shared = (np.array(part) for part in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("doc_id").take(pa.array(texts)),
                        chunk.column("tag").take(pa.array(texts)),
                        ids.take(pa.array(hits)),
                        pa.array(sizes[hits]),
                        pa.array(shared),
                        pa.array(shared / sizes[hits]),
                    ],
                    names=["doc_id", "tag", "item_id", "n_item_shingles", "n_shared", "containment"],
                )

    return rows


def _marks(width: int, shingles: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Places of a shingle in a filter of ``bits`` (a power of two) bits."""
    first = tb.mix(shingles + np.uint64(width))
    step = tb.mix(first) | np.uint64(1)
    for mark in range(FILTER_MARKS):
        yield (first + np.uint64(mark) * step) & np.uint64(bits - 1)


def _mark_words(bits: int):
    """Sketch values (width, shingle) to 64-bit words of the filter: place of the word and bits set in it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(0).to_numpy()
            shingles = batch.column(1).to_numpy().view(np.uint64)
            for width in np.unique(widths):
                for places in _marks(int(width), shingles[widths == width], bits):
                    words, marks = (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63))
                    yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(tb.as_signed(marks))], names=["word", "marks"])

    return rows


def sketch_filter(sketches: DataFrame, count: int) -> np.ndarray:
    """A Bloom filter of (width, shingle) rows as 64-bit words; their union is made by Spark, its size is bounded."""
    bits = min(8 * FILTER_BYTES, 1 << max(10, (FILTER_BITS * max(count, 1) - 1).bit_length()))
    words = sketches.select("width", "shingle").mapInArrow(_mark_words(bits), "word long, marks long")
    found = words.groupBy("word").agg(F.bit_or("marks").alias("marks")).toPandas()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[found["word"].to_numpy()] = found["marks"].to_numpy().view(np.uint64)
    return out


def _windows(widths: list[int], held: np.ndarray | None = None):
    """The distinct windows of each text, of those ``held`` (a filter) may hold; with the text's number of windows."""

    def passing(width: int, shingles: np.ndarray) -> np.ndarray:
        kept = np.ones(len(shingles), dtype=bool)
        for places in _marks(width, shingles, 64 * len(held)):
            kept &= held[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63)) & np.uint64(1) == 1
        return kept

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in tb.chunks(batches):
            words = tb.Words(chunk, lower=True)
            values = words.values()
            for width in widths:
                texts, shingles = tb.windows(words, values, width, short_whole=False)
                per_text = np.bincount(texts, minlength=chunk.texts)
                if held is not None:
                    kept = passing(width, shingles)
                    texts, shingles = texts[kept], shingles[kept]
                texts, shingles = tb.distinct(texts, shingles)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(chunk.column(key).take(pa.array(texts)) for key in ("doc_id", "tag")),
                        pa.array(per_text[texts].astype(np.int64)), pa.array(np.full(len(texts), width)), pa.array(tb.as_signed(shingles)),
                    ],
                    names=["doc_id", "tag", "n_windows", "width", "shingle"],
                )

    return rows


def _joined(docs: DataFrame, items: DataFrame, containment: int) -> DataFrame:
    """The same search for a benchmark of any size."""
    widths = sorted(row["width"] for row in items.select("width").distinct().collect())  # 1 to 5
    numbered = stored(items.withColumn("item", F.xxhash64("width", "shingles")), "items")
    fewest = F.expr(f"cast(ceil({containment} * n / 100) as long)")
    by_hash = F.expr("transform(array_sort(transform(shingles, s -> struct(xxhash64(s) as h, s as s))), p -> p.s)")
    # A size class: items whose sizes have as many binary digits.
    size_class = F.length(F.bin("n")).alias("size_class")
    kept = numbered.select("item_id", "item", "n", "width", size_class, fewest.alias("fewest"), F.explode(F.slice(by_hash, F.lit(1), (F.col("n") - fewest + 1).cast("int"))).alias("shingle"))
    sketches = stored(kept, "item-sketches")
    bounds = sketches.groupBy("width", "size_class").agg(F.min("fewest").alias("class_fewest"))
    sketches = stored(sketches.drop("fewest").join(bounds, ["width", "size_class"]), "item-classes")
    values = stored(sketches.select("width", "shingle").distinct(), "sketch-values")
    held = sketch_filter(values, values.count())
    hits = docs.mapInArrow(_windows(widths, held), WINDOWS)
    pairs = hits.join(sketches, ["width", "shingle"]).where("n_windows >= class_fewest").select("doc_id", "tag", "item_id", "item", "n", "width").distinct()
    pairs = stored(pairs, "candidates")
    touched = stored(pairs.select("doc_id", "tag").distinct(), "touched")
    # Documents' windows meet a candidate's shingles by the pair: no shingle is joined with items that are not candidates.
    again = only_ids(docs, touched, ["doc_id", "tag"]).mapInArrow(_windows(widths), WINDOWS).distinct()
    whole = pairs.join(numbered.select(F.col("item_id").alias("_id"), F.col("item").alias("_item"), "shingles"), F.col("item_id").eqNullSafe(F.col("_id")) & (F.col("item") == F.col("_item")))
    wanted = whole.select("doc_id", "tag", "item_id", "item", "n", "width", F.explode("shingles").alias("shingle"))
    mine = again.select(F.col("doc_id").alias("_doc"), F.col("tag").alias("_tag"), F.col("width").alias("_width"), F.col("shingle").alias("_shingle"))
    same = wanted["doc_id"].eqNullSafe(mine["_doc"]) & (wanted["tag"] == mine["_tag"]) & (wanted["width"] == mine["_width"]) & (wanted["shingle"] == mine["_shingle"])
    shared = wanted.join(mine, same, "left_semi").groupBy("doc_id", "tag", "item_id", "item", "n").agg(F.count("*").alias("n_shared"))
    return shared.where(f"100 * n_shared >= {containment} * n").select("doc_id", "tag", "item_id", F.col("n").alias("n_item_shingles"), "n_shared", (F.col("n_shared") / F.col("n")).alias("containment"))


def _tag(text: Column) -> Column:
    """Rows are told apart by their id and this, a null text too."""
    return F.xxhash64(text.cast("string"))


def _found(documents: DataFrame, benchmark: DataFrame, containment: int, index_values: int) -> DataFrame:
    """``RESULT``: a row for each text and item found in it, by either search; each text is judged alone."""
    docs = documents_of(documents).withColumn("tag", _tag(F.col("text")))
    items = stored(item_sets(benchmark), "item-sets")
    total = items.agg(F.sum("n")).first()[0] or 0
    if total <= index_values:
        return docs.mapInArrow(_searcher(items.orderBy("width", "n", "item_id").toPandas(), containment), RESULT)
    return _joined(docs, items, containment)


def contaminated(documents: DataFrame, benchmark: DataFrame, containment: int = CONTAINMENT, index_values: int = INDEX_VALUES) -> DataFrame:
    """One row for each document and item found in it: doc_id, item_id, n_item_shingles, n_shared and containment.

    Several rows of one id are judged each by its own text and give the best of them. Null and empty texts hold nothing
    and are never found; null ids are reported as they are. Empty tables give no rows.
    """
    found = _found(documents, benchmark, containment, index_values)
    best = F.max(F.struct("containment", "n_item_shingles", "n_shared"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.n_item_shingles", "best.n_shared", "best.containment")


def keep_clean(documents: DataFrame, benchmark: DataFrame, containment: int = CONTAINMENT, index_values: int = INDEX_VALUES) -> DataFrame:
    """The rows in whose text no item was found, unchanged, whatever other rows have their id or none."""
    tag = "_text_tag"
    while tag in documents.columns:
        tag = f"_{tag}"
    hit = stored(_found(documents, benchmark, containment, index_values).select("doc_id", F.col("tag").alias(tag)).distinct(), "contaminated")
    return only_ids(documents.withColumn(tag, _tag(F.col("text"))), hit, ["doc_id", tag], "left_anti").drop(tag)
