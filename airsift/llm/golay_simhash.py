"""SimHash near-dedup by Golay keys: fingerprints that differ in few bits share a nearby codeword in some segment.

The perfect (23, 12, 7) Golay code puts every 23-bit word within three bits of exactly one of 4,096 codewords. A word is
decoded to the index of its codeword; its *nearby* indices are those of itself and of its 23 neighbours at one bit, six
of them or one. Words that differ in at most one bit: the index of either is a nearby index of the other.

Pigeonhole over a 64-bit fingerprint with at most ``MOST_BITS`` = 3 differing bits:

- of four segments of 16 bits, one is equal;
- the other 48 bits are two halves of 24, of which one holds at most one differing bit, so also its first 23 bits.

So each of the eight pairs (equal segment, half) is a table keyed by 16 + 12 bits. A fingerprint is stored under one key in
each (its half's index) and searched under the half's nearby indices, one to six. Every linked pair meets in some table,
in both directions, and is confirmed by counting bits. Keys are ``int`` numbers below 2^31.

Equal fingerprints are one node. Near copies crowd into the same keys, so pairs are not formed at once:

1. Each fingerprint is compared with the least one stored under each of its keys; found links give classes.
2. Keys that hold more than one class are joined again, all but the pairs inside a key's largest class: what is stored
   outside of it is compared with all that search the key, what is stored in it with those from outside. So a group
   whose members are joined already costs no pairs. Two linked fingerprints may meet under a key each only, one stored
   and the other searching; each can lie in the largest class of its own key, so neither side may be left out alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsift.llm import textbatch as tb
from airsift.llm.components import components
from airsift.llm.store import documents_of, stored

WIDTH = 3
SEED = 42
MOST_BITS = 3

CODE_BITS, MESSAGE_BITS = 23, 12
CHECK_BITS = CODE_BITS - MESSAGE_BITS
# x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the code; polynomials over GF(2) as numbers, highest power first.
GENERATOR = 0b101011100011

# Bits that may differ are looked for in one half of what remains beside an equal segment.
SEGMENTS, SEGMENT_BITS, HALF_BITS = 4, 16, 24

# Texts' hashes are summed in bytes, which hold up to 255 of them.
BYTE_SUM = 255


@cache
def _syndromes() -> np.ndarray:
    """Remainder of each single bit by the generator."""
    out = []
    for bit in range(CODE_BITS):
        rest = 1 << bit
        for high in range(bit, CHECK_BITS - 1, -1):
            if rest >> high & 1:
                rest ^= GENERATOR << (high - CHECK_BITS)
        out.append(rest)
    return np.array(out, dtype=np.int32)


def _remainders(words: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    low, high = tables
    return low[words & (len(low) - 1)] ^ high[words >> MESSAGE_BITS]


@cache
def _tables() -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Remainders of the low 12 and the high 11 bits of a word, and the error of up to three bits for each remainder."""
    single = _syndromes()

    def summed(bits: np.ndarray) -> np.ndarray:
        out = np.zeros(1, dtype=np.int32)
        for value in bits:
            out = np.concatenate([out, out ^ value])
        return out

    tables = summed(single[:MESSAGE_BITS]), summed(single[MESSAGE_BITS:])
    ones = 1 << np.arange(CODE_BITS)
    two = (ones[:, None] | ones[None, :]).ravel()
    three = (two[:, None] | ones[None, :]).ravel()
    patterns = np.unique(np.concatenate([[0], three]))
    errors = np.zeros(1 << CHECK_BITS, dtype=np.int32)
    errors[_remainders(patterns, tables)] = patterns
    return tables, errors


def decode(words: np.ndarray) -> np.ndarray:
    """Index (0 to 4,095) of the codeword nearest to each 23-bit word: the message bits of the corrected word."""
    tables, errors = _tables()
    return (words ^ errors[_remainders(words, tables)]) >> CHECK_BITS


def nearby(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, index): the distinct indices of each word and of its neighbours at one bit."""
    flips = np.append(0, 1 << np.arange(CODE_BITS))
    found = np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    places, _ = np.nonzero(new)
    return places, found[new]


def _halves(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each pair (equal segment, half): the head of the key, and the 23 bits that are decoded."""
    segments = [(prints >> np.uint64(SEGMENT_BITS * k)).astype(np.int64) & 0xFFFF for k in range(SEGMENTS)]
    for equal in range(SEGMENTS):
        rest = np.zeros(len(prints), dtype=np.int64)
        for k in range(SEGMENTS):
            if k != equal:
                rest = rest << SEGMENT_BITS | segments[k]
        for half in range(2):
            head = (2 * equal + half) << SEGMENT_BITS | segments[equal]
            yield head << MESSAGE_BITS, (rest >> HALF_BITS * half) & ((1 << CODE_BITS) - 1)


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        yield batch.column(batch.schema.get_field_index("fp")).to_numpy(zero_copy_only=False).view(np.uint64)


def _stored_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for prints in _print_batches(batches):
        for head, half in _halves(prints):
            yield pa.RecordBatch.from_arrays([pa.array((head | decode(half)).astype(np.int32)), pa.array(tb.as_signed(prints))], names=["key", "fp"])


def _search_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for prints in _print_batches(batches):
        for head, half in _halves(prints):
            places, indices = nearby(half)
            yield pa.RecordBatch.from_arrays([pa.array((head[places] | indices).astype(np.int32)), pa.array(tb.as_signed(prints[places]))], names=["key", "fp"])


@cache
def _spread() -> np.ndarray:
    """Each byte's eight bits, one to a byte of a 64-bit number."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view(np.uint64).ravel()


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A fingerprint for each run ``bounds[i]`` to ``bounds[i + 1]`` of hashes: bits set in over half of them; 0 if none."""
    counts = np.diff(bounds)
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    # Partial sums over at most 255 hashes of a text, in bytes; then over a text's parts.
    parts = -(-counts[full] // BYTE_SUM)
    first = np.cumsum(parts) - parts
    within = np.arange(parts.sum()) - np.repeat(first, parts)
    cuts = np.repeat(bounds[:-1][full], parts) + BYTE_SUM * within
    lanes = _spread()[hashes.astype("<u8").view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, cuts, axis=0).view(np.uint8).reshape(len(cuts), 64)
    totals = np.add.reduceat(sums.astype(np.int64), first, axis=0)
    bits = (2 * totals > counts[full, None]).astype(np.uint8)
    out[full] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _fingerprints(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for chunk in tb.chunks(batches):
            words = tb.Words(chunk, lower=True)
            # Words joined by one space each: a shingle is a slice of that.
            lengths = words.ends - words.starts
            ends = np.cumsum(lengths + 1) - 1
            starts = ends - lengths
            joined = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, dtype=np.uint8)
            joined[np.repeat(starts - words.starts, lengths) + _inside(words.starts, lengths)] = words.data[_inside(words.starts, lengths)]
            shingles = np.where(words.counts >= width, words.counts - width + 1, np.minimum(words.counts, 1))
            bounds = np.append(0, np.cumsum(shingles))
            first = np.repeat(words.ranges[:-1] - bounds[:-1], shingles) + np.arange(bounds[-1])
            last = first + np.repeat(np.minimum(width, words.counts), shingles) - 1
            held = memoryview(joined)
            hashes = np.fromiter(
                (digest(held[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[last].tolist())), dtype=np.uint64, count=len(first)
            )
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(tb.as_signed(majority(hashes, bounds)))], names=["doc_id", "fp"])

    return rows


def _inside(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Every place of the runs, one after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def fingerprints(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows (doc_id, fp): the 64-bit SimHash of each text's lower-cased word shingles, repeats included, as a signed long.

    A text with fewer than ``width`` words is one shingle; one without words, or null, has fingerprint 0.
    """
    return documents_of(documents).mapInArrow(_fingerprints(width), "doc_id long, fp long")


def _differing(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def classes(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Distinct fingerprints (fp) to (fp, label) for those linked with others; label is the least fingerprint reachable.

    ``most_bits`` may be 0 to 3, what the pigeonhole argument holds for.
    """
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError(f"links of up to {MOST_BITS} differing bits can be found, not {most_bits}")
    kept = stored(prints.mapInArrow(_stored_keys, "key int, fp long"), "golay-stored")
    search = stored(prints.mapInArrow(_search_keys, "key int, fp long"), "golay-search")

    # Fingerprints alone under their keys, stored and searched, meet nobody: only shared keys go on.
    least = stored(kept.groupBy("key").agg(F.min("fp").alias("least")), "golay-least")
    stars = search.join(least, "key").where((F.col("fp") != F.col("least")) & (_differing("fp", "least") <= most_bits))
    stars = stored(stars.select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct(), "golay-stars")
    labels = stored(components(stars), "golay-labels")

    def labelled(entries: DataFrame) -> DataFrame:
        return entries.join(labels, F.col("fp") == F.col("node"), "left").select("key", "fp", F.coalesce("label", "fp").alias("label"))

    # A key's classes over stored and searched entries: one class needs no more pairs.
    mixed = labelled(search).groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    mixed = stored(mixed.select("key"), "golay-mixed")
    inside = stored(labelled(kept).join(mixed, "key", "left_semi"), "golay-inside")
    largest = inside.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("largest"))
    largest = stored(largest, "golay-largest")
    inside = inside.join(largest, "key").select("key", F.col("fp").alias("other"), F.col("label").alias("other_label"), (F.col("label") == F.col("largest")).alias("in_largest"))
    inside = stored(inside, "golay-placed")
    asking = stored(labelled(search).join(largest, "key"), "golay-asking")

    def found(entries: DataFrame, others: DataFrame) -> DataFrame:
        pairs = entries.join(others, "key").where((F.col("label") != F.col("other_label")) & (_differing("fp", "other") <= most_bits))
        return pairs.select(F.col("label").alias("a"), F.col("other_label").alias("b"))

    links = found(asking, inside.where("not in_largest")).union(found(asking.where("label <> largest"), inside.where("in_largest"))).distinct()
    return components(stars.union(stored(links, "golay-links"))).select(F.col("node").alias("fp"), "label")


def near_duplicates(documents: DataFrame, width: int = WIDTH, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable, itself included).

    Documents are linked if their fingerprints differ in at most ``most_bits`` bits. Null and empty texts and those
    without words have fingerprint 0 and are linked like any other. Every row is a document of its own, also with a
    repeated id; a row without an id takes part, and its component_id is null only if no row it is linked with has
    one. Texts are read whole, ties need no rule, an empty table gives no rows, and other columns are ignored.
    """
    rows = stored(fingerprints(documents, width), "simhash")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "prints")
    found = classes(prints.select("fp"), most_bits)
    labelled = stored(prints.join(found, "fp", "left").select("fp", "least_id", F.coalesce("label", "fp").alias("label")), "print-labels")
    least = labelled.groupBy("label").agg(F.min("least_id").alias("component_id"))
    of_print = stored(labelled.join(least, "label").select("fp", "component_id"), "print-components")
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(of_print, "fp").select("doc_id", fingerprint, "component_id")
