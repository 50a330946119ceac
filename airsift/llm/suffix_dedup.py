"""Repeated passages of bytes: suffixes grouped by fingerprints of anchored digits, only through the threshold.

Each start of a ``threshold``-byte string is a suffix; strings that two or more suffixes start with are the repeated
ones. Nothing is radix sorted and no digit is the leading bytes: that takes a row for every byte of text in the first
pass. Grouping by fingerprints replaces the passes and finds the same strings, up to collisions. A suffix leaves as soon
as it is alone, so few reach the last step, and suffixes that share a digit move together:

1. The anchor of a suffix is the position with the least hash in its first ``SPREAD`` bytes (winnowing): equal suffixes
   have equal anchors. Suffixes with one anchor, about a hundred in a row, form a block. Digit: the bytes from the anchor
   on that all of them hold, 209 at a threshold of 400, which begin up to 191 bytes inside the suffix. A block whose whole
   extent recurs is repeated throughout and settled; an anchor whose digit is alone is unique throughout.
2. What is left is cut into steps of ``STEP`` suffixes, counted from the anchor, and treated alike: digit is what all
   suffixes of the step hold.
3. Then single suffixes; digit is the whole string.

Digits and extents are compared by two independent 64-bit fingerprints. Groups are counts with partial sums and joins,
never lists, so a passage in a third of all documents is no more than a count. Of settled blocks with equal extents one
stands for all in the next pass. Tables are dropped as soon as what was made of them is stored.

Passages of over 50 words may be shorter than the threshold. They are found alike, with words for bytes: anchors are
grams of ``GRAM_WORDS`` words, and runs of words are formed only around anchors that recur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsift.llm import textbatch as tb
from airsift.llm.store import documents_of, drop_stored, only_ids, stored

THRESHOLD = 400
# Share of the threshold in which a suffix looks for its anchor; the rest is the first digit.
SPREAD = 0.5
GRAM = 8
STEP = 16
# Words of a passage that is told, and of its anchor.
RUN = 51
GRAM_WORDS = 16

BLOCKS = "doc_id long, tag long, low int, high int, anchor int, digit long, extent long"
REMOVED = "doc_id long, tag long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, places array<int>, grams array<long>"


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, from running minima forwards and backwards in blocks."""
    count = len(values)
    table = np.concatenate([values, np.full(-count % width, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: count - width + 1], forward[width - 1 : count])


def _blocks(threshold: int):
    spread = max(1, int(threshold * SPREAD) - GRAM)
    gram = min(GRAM, threshold)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in tb.chunks(batches):
            size = len(chunk.data)
            if size < threshold:
                continue
            first, second = tb.FIRST.sums(chunk.data), tb.SECOND.sums(chunk.data)
            places = np.arange(size - gram + 1)
            hashed = tb.mix(tb.FIRST.between(first, places, places + gram))
            # High half: hash; low half: place, so that of equal hashes the leftmost is least.
            ranked = (hashed & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64)
            anchors = (_sliding_least(ranked, spread) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            lengths = np.diff(chunk.bounds)
            owner = np.repeat(np.arange(chunk.texts), lengths)[: size - threshold + 1]
            starts = np.flatnonzero(np.arange(size - threshold + 1) + threshold <= chunk.bounds[owner + 1])
            if not len(starts):
                continue
            owner, anchors = owner[starts], anchors[starts]
            new = np.ones(len(starts), dtype=bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
            at = np.flatnonzero(new)
            low, high = starts[at], starts[np.append(at[1:], len(starts)) - 1] + 1
            anchors, owner = anchors[at], owner[at]
            base = chunk.bounds[owner]
            texts = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id").take(texts),
                    chunk.column("tag").take(texts),
                    *(pa.array((part - base).astype(np.int32)) for part in (low, high, anchors)),
                    pa.array(tb.as_signed(tb.mix(tb.FIRST.between(first, anchors, anchors + threshold - spread + 1)))),
                    pa.array(tb.as_signed(tb.mix(tb.SECOND.between(second, low, high - 1 + threshold) + (high - low).astype(np.uint64)))),
                ],
                names=[part.split()[0] for part in BLOCKS.split(", ")],
            )

    return rows


def _steps(threshold: int):
    """Rows (doc_id, tag, text, blocks) to steps, each with fingerprints of its suffixes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in tb.chunks(batches):
            spans = chunk.column("spans")
            fields = spans.flatten()
            base = np.repeat(chunk.bounds[:-1], np.diff(spans.offsets.to_numpy()))
            owner = np.repeat(np.arange(chunk.texts), np.diff(spans.offsets.to_numpy()))
            low, high, anchor = (fields.field(k).to_numpy().astype(np.int64) + base for k in range(3))
            settled = fields.field(3).to_numpy(zero_copy_only=False)
            # Step k holds the starts from anchor - STEP * (k + 1) + 1 through anchor - STEP * k.
            nearest, farthest = (anchor - high + 1) // STEP, (anchor - low) // STEP
            many = farthest - nearest + 1
            of = np.repeat(np.arange(len(low)), many)
            k = nearest[of] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            last, begin = anchor[of] - STEP * k, anchor[of] - STEP * (k + 1) + 1
            low, high = np.maximum(low[of], begin), np.minimum(high[of], last + 1)
            first, second = tb.FIRST.sums(chunk.data), tb.SECOND.sums(chunk.data)
            counts = high - low
            each = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            # What all starts of a full step hold; near a text's begin the step is shorter, but this part is there.
            core = tb.mix(tb.FIRST.between(first, last, begin + threshold))
            extent = tb.mix(tb.SECOND.between(second, low, high - 1 + threshold) + counts.astype(np.uint64))
            texts = pa.array(owner[of])
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id").take(texts),
                    chunk.column("tag").take(texts),
                    *(pa.array((part - chunk.bounds[owner[of]]).astype(np.int32)) for part in (low, high)),
                    pa.array(settled[of]),
                    pa.array(tb.as_signed(core)),
                    pa.array(tb.as_signed(extent)),
                    tb.long_lists(np.append(0, np.cumsum(counts)), tb.mix(tb.SECOND.between(second, each, each + threshold))),
                ],
                names=["doc_id", "tag", "low", "high", "settled", "digit", "extent", "strings"],
            )

    return rows


def _word_anchors(chunk: tb.Chunk, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds of each text's, word place in the text, fingerprint): grams of words such that each ``run`` of them holds one."""
    words = tb.Words(chunk, lower=False)
    total, gram = len(words.starts), min(GRAM_WORDS, run)
    if total < run:
        return np.zeros(chunk.texts + 1, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    sums = tb.FIRST.sums_of(words.values())
    places = np.arange(total - gram + 1)
    grams = tb.mix(tb.FIRST.between(sums, places, places + gram))
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64)
    least = (_sliding_least(ranked, run - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = words.text_of_each()
    anchors = np.unique(least[owner[: total - run + 1] == owner[run - 1 :]])
    return np.searchsorted(anchors, words.ranges), anchors - words.ranges[owner[anchors]], grams[anchors]


def _covered(threshold: int, run: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in tb.chunks(batches):
            spans = chunk.column("spans")
            out = []
            for text in range(chunk.texts):
                data = chunk.data[chunk.bounds[text] : chunk.bounds[text + 1]]
                marks = np.zeros(len(data) + 1, dtype=np.int64)
                found = spans[text]
                if found.is_valid and len(found):
                    np.add.at(marks, found.values.field(0).to_numpy(), 1)
                    np.add.at(marks, found.values.field(1).to_numpy() - 1 + threshold, -1)
                gone = np.cumsum(marks[:-1]) > 0
                runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((len(data), int(gone.sum()), runs, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            sizes, removed, runs, digests = zip(*out)
            bounds, places, grams = _word_anchors(chunk, run)
            own = [chunk.column("doc_id"), chunk.column("tag"), *(pa.array(part, pa.int64()) for part in (sizes, removed, runs)), pa.array(digests, pa.string())]
            anchors = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(places.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*own, anchors, tb.long_lists(bounds, grams)], names=[part.split()[0] for part in REMOVED.split(", ")])

    return rows


def _word_runs(run: int):
    """Rows (doc_id, tag, text, spans) to the fingerprints of every run of words that holds a listed anchor."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in tb.chunks(batches):
            spans = chunk.column("spans")
            words = tb.Words(chunk, lower=False)
            values = words.values()
            owner = np.repeat(np.arange(chunk.texts), np.diff(spans.offsets.to_numpy()))
            anchors = spans.flatten().field(0).to_numpy() + words.ranges[owner]
            reach = run - min(GRAM_WORDS, run) + 1
            starts, owner = (anchors[:, None] - np.arange(reach)).ravel(), np.repeat(owner, reach)
            inside = (starts >= words.ranges[owner]) & (starts + run <= words.ranges[owner + 1])
            starts, first = np.unique(starts[inside], return_index=True)
            texts = pa.array(owner[inside][first])
            found = (tb.mix(kind.between(kind.sums_of(values), starts, starts + run)) for kind in (tb.FIRST, tb.SECOND))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id").take(texts), chunk.column("tag").take(texts), *(pa.array(tb.as_signed(part)) for part in found)],
                names=["doc_id", "tag", "run", "other"],
            )

    return rows


def _with_spans(docs: DataFrame, spans: DataFrame, columns: list[str]) -> DataFrame:
    """Texts of the documents that have spans, with the list of them: bounded by the text itself."""
    ids = stored(spans.select("doc_id").distinct(), "span-ids")
    lists = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct(*columns)).alias("spans")).select(F.col("doc_id").alias("of"), F.col("tag").alias("with"), "spans")
    texts = only_ids(docs, ids, ["doc_id"])
    return texts.join(lists, texts["doc_id"].eqNullSafe(lists["of"]) & (texts["tag"] == lists["with"])).select("doc_id", "tag", "text", "spans")


def repeated_starts(docs: DataFrame, threshold: int) -> DataFrame:
    """Stored rows (doc_id, tag, low, high): starts low to high (exclusive) of strings that occur elsewhere too."""
    blocks = stored(docs.mapInArrow(_blocks(threshold), BLOCKS), "blocks")
    place = F.struct("doc_id", "tag", "low")
    extents = stored(blocks.groupBy("digit", "extent").agg(F.count("*").alias("n"), F.min(place).alias("first")), "extents")
    digits = extents.groupBy("digit").agg(F.sum("n").alias("total"), F.count("*").alias("different")).where("total > 1")
    live = stored(extents.join(digits, "digit").select("digit", "extent", "n", "first", "different"), "live")
    here = stored(blocks.join(live, ["digit", "extent"]), "live-blocks")
    drop_stored(blocks, extents, live)
    settled = here.where("n > 1").select("doc_id", "tag", "low", "high")
    open_blocks = here.where(F.col("different") > 1).where((F.col("n") == 1) | F.col("first").eqNullSafe(place))
    open_blocks = open_blocks.select("doc_id", "tag", "low", "high", "anchor", (F.col("n") > 1).alias("settled"))
    open_blocks = stored(open_blocks.distinct(), "open-blocks")
    schema = "doc_id long, tag long, low int, high int, settled boolean, digit long, extent long, strings array<long>"
    steps = stored(_with_spans(docs, open_blocks, ["low", "high", "anchor", "settled"]).mapInArrow(_steps(threshold), schema).dropDuplicates(["doc_id", "tag", "low", "high"]), "steps")
    drop_stored(open_blocks)
    extents = steps.groupBy("digit", "extent").agg(F.count("*").alias("n"), F.max("settled").alias("known"), F.min(place).alias("first"))
    extents = stored(extents, "step-extents")
    digits = extents.groupBy("digit").agg(F.sum("n").alias("total"), F.count("*").alias("different"), F.min("known").alias("all_known")).where("total > 1")
    live = stored(extents.join(digits, "digit").select("digit", "extent", "n", "known", "first", "different", "all_known"), "live-steps")
    live_steps = stored(steps.join(live, ["digit", "extent"]), "live-step-rows")
    drop_stored(steps, extents, live)
    # An equal extent in a settled block settles its equals too.
    by_step = live_steps.where("n > 1 and not settled").select("doc_id", "tag", "low", "high")
    single = live_steps.where("different > 1 and not all_known").where((F.col("n") == 1) | F.col("first").eqNullSafe(place))
    single = single.select("doc_id", "tag", "low", "digit", (F.col("settled") | (F.col("n") > 1)).alias("settled"), F.posexplode("strings").alias("step", "string"))
    single = stored(single, "strings")
    often = single.groupBy("digit", "string").agg(F.count("*").alias("n"), F.min(F.col("settled").cast("int")).alias("all_settled")).where("n > 1 and all_settled = 0")
    by_string = single.where("not settled").join(often, ["digit", "string"], "left_semi").select("doc_id", "tag", (F.col("low") + F.col("step")).alias("low"), (F.col("low") + F.col("step") + 1).alias("high"))
    repeats = stored(settled.union(by_step).union(by_string), "repeats")
    drop_stored(here, live_steps, single)
    return repeats


def _removed(docs: DataFrame, threshold: int, run: int) -> DataFrame:
    spans = repeated_starts(docs, threshold)
    hit = _with_spans(docs, spans, ["low", "high"]).mapInArrow(_covered(threshold, run), REMOVED)
    keys = stored(spans.select("doc_id", "tag").distinct(), "hit")
    free = only_ids(docs, keys, ["doc_id", "tag"], "left_anti").withColumn("spans", F.expr("cast(null as array<struct<low: int, high: int>>)"))
    return hit.union(free.mapInArrow(_covered(threshold, run), REMOVED))


def shared_runs(docs: DataFrame, removed: DataFrame, run: int) -> DataFrame:
    """Distinct (doc_id, tag) of rows without removed bytes that hold ``run`` words which start elsewhere too.

    Anchors first, as above; then all runs around the anchors that such a row has in common with any other place.
    """
    entries = removed.select("doc_id", "tag", (F.col("n_removed") == 0).alias("open"), F.explode(F.arrays_zip("places", "grams")).alias("anchor"))
    entries = entries.select("doc_id", "tag", "open", F.col("anchor.places").alias("place"), F.col("anchor.grams").alias("gram"))
    live = stored(entries.groupBy("gram").agg(F.count("*").alias("n"), F.max("open").alias("open")).where("n > 1 and open").select("gram"), "word-anchors")
    around = stored(entries.join(live, "gram").select("doc_id", "tag", "place").distinct(), "word-places")
    runs = stored(_with_spans(docs, around, ["place"]).mapInArrow(_word_runs(run), "doc_id long, tag long, run long, other long"), "word-runs")
    often = runs.groupBy("run", "other").agg(F.count("*").alias("n")).where("n > 1")
    found = stored(runs.join(often, ["run", "other"], "left_semi").select("doc_id", "tag").distinct(), "word-repeats")
    drop_stored(live, around, runs)
    return found


def remove_repeats(documents: DataFrame, threshold: int = THRESHOLD, run: int = RUN) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and has_repeat.

    Removed is each UTF-8 byte covered by a ``threshold``-byte string that also starts anywhere else, in this or another
    row; strings are judged on the input. ``has_repeat`` is true if bytes were removed, or ``run`` consecutive words
    (without regard to the white space between them) start anywhere else too: short words make a passage of over 50 words
    shorter than 400 bytes, which is told but not removed. Null and empty texts have no bytes and no words. Every row is
    a text of its own: repeated rows repeat each other. Rows of one id, or of none, are told apart by a 64-bit hash of the
    text. An empty table gives no rows.
    """
    docs = documents_of(documents).withColumn("tag", F.xxhash64("text"))
    removed = stored(_removed(docs, threshold, run), "removed")
    repeated = shared_runs(docs, removed, run)
    found = only_ids(removed, repeated, ["doc_id", "tag"]).withColumn("has_repeat", F.lit(True))
    rest = only_ids(removed, repeated, ["doc_id", "tag"], "left_anti").withColumn("has_repeat", F.col("n_removed") > 0)
    return found.union(rest).drop("tag", "places", "grams")
