"""Near-duplicate documents: fast similarity sketches, banding, and exact verification.

A document's set holds its distinct five-word shingles (words without ASCII white space, A-Z lower-cased); a shorter
text is one shingle, an empty or null text has none and is linked with nothing. Two documents are linked if
100 * shared >= similarity * union.

1. Sketch: each round hashes every shingle to one of ``COORDINATES`` bins with a value; a bin keeps the least value of
   the first round that reaches it. From round ``COORDINATES`` on, round k serves one bin with all shingles, so every
   coordinate fills. Sets with many shingles are done after a round or two.
2. Documents with equal sets are one node (its least id). Sketches are cut into ``BANDS`` bands; nodes that share a
   band are candidates. At a similarity of 0.85, 2.6e-7 of the links share no band.
3. In each band bucket every node is compared with the bucket's least one, on full sets, and components are formed.
   A bucket then matters only where its nodes lie in several components. Their remaining links are found by an exact
   prefix join: shingles are ordered from rare to frequent, and a pair can reach the similarity only if the first
   shingles of both, as many as the bound allows, share one at fitting positions. So a bucket of thousands of loosely
   similar texts gives no square of pairs, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsift.llm import textbatch as tb
from airsift.llm.components import components
from airsift.llm.store import documents_of, only_ids, stored

SIMILARITY = 85
BANDS, BAND_ROWS = 32, 6
COORDINATES = BANDS * BAND_ROWS
# Cells of the count table that orders shingles from rare to frequent; any order gives the same links.
CELLS = 1 << 18

_SEEDS = np.random.Generator(np.random.PCG64(6)).integers(0, 2**64, 2 * COORDINATES + BAND_ROWS + BANDS, dtype=np.uint64)


def similarity_sketch(bounds: np.ndarray, values: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """One row of ``coordinates`` values for each set; rows of empty sets stay at the largest value."""
    texts = len(bounds) - 1
    flat = np.full(texts * coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    filled = np.zeros(texts * coordinates, dtype=bool)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(texts), sizes)
    for step in range(2 * coordinates):
        if not len(values):
            break
        hashed = tb.mix(values ^ _SEEDS[step])
        if step < coordinates:
            bins = ((hashed >> np.uint64(32)) * np.uint64(coordinates) >> np.uint64(32)).astype(np.int64)
        else:
            bins = step - coordinates
        slots = owner * coordinates + bins
        free = ~filled[slots]
        slots, hashed = slots[free], hashed[free]
        np.minimum.at(flat, slots, hashed)
        filled[slots] = True
        if step < 4 or step % 8 == 0:
            open_texts = ~filled.reshape(texts, coordinates).all(axis=1)
            stay = open_texts[owner]
            owner, values = owner[stay], values[stay]
    return flat.reshape(texts, coordinates)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in tb.chunks(batches):
        bounds, values = tb.shingle_sets(chunk)
        sizes = np.diff(bounds)
        table = similarity_sketch(bounds, values).reshape(chunk.texts, BANDS, BAND_ROWS)
        weights = _SEEDS[2 * COORDINATES : 2 * COORDINATES + BAND_ROWS] | np.uint64(1)
        bands = tb.mix((table * weights).sum(axis=2, dtype=np.uint64) + _SEEDS[-BANDS:])
        # Sums over the set name it: equal sets, equal pairs of sums.
        totals = [np.append(np.zeros(1, np.uint64), np.cumsum(tb.mix(values ^ _SEEDS[k]), dtype=np.uint64)) for k in (0, 1)]
        first, second = (total[bounds[1:]] - total[bounds[:-1]] for total in totals)
        has = sizes > 0
        list_bounds = np.append(0, np.cumsum(has * BANDS))
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("doc_id"),
                pa.array(sizes.astype(np.int64)),
                pa.array(tb.as_signed(first)),
                pa.array(tb.as_signed(second)),
                tb.long_lists(list_bounds, bands[has].ravel()),
            ],
            names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in tb.chunks(batches):
        bounds, values = tb.shingle_sets(chunk)
        yield pa.RecordBatch.from_arrays(
            [chunk.column("doc_id"), pa.array(np.diff(bounds)), tb.long_lists(bounds, values)], names=["doc_id", "n", "shingles"]
        )


def _set_arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(batch.schema.get_field_index("shingles"))
    bounds = column.offsets.to_numpy()
    return bounds - bounds[0], column.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]].view(np.uint64)


def _cell(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CELLS, dtype=np.int64)
    for batch in batches:
        counts += np.bincount(_cell(_set_arrays(batch)[1]), minlength=CELLS)
    cells = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], names=["cell", "count"])


def _prefixes(frequency: np.ndarray, similarity: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, values = _set_arrays(batch)
            sizes = np.diff(bounds)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((values, frequency[_cell(values)], owner))
            values = values[order]
            place = np.arange(len(values)) - np.repeat(bounds[:-1], sizes)
            long_prefix = sizes - -(-similarity * sizes // 100) + 1
            kept = place < long_prefix[owner]
            at = owner[kept]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(at)),
                    batch.column(batch.schema.get_field_index("label")).take(pa.array(at)),
                    pa.array(sizes[at].astype(np.int64)),
                    pa.array(place[kept].astype(np.int64)),
                    pa.array(tb.as_signed(values[kept])),
                ],
                names=["id", "label", "n", "place", "shingle"],
            )

    return rows


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets reach the similarity."""
    sizes = sets.select("doc_id", "n")
    left, right = (sizes.select(F.col("doc_id").alias(k), F.col("n").alias(f"n{k}")) for k in "ab")
    near = pairs.join(left, "a").join(right, "b").where(f"100 * least(na, nb) >= {similarity} * greatest(na, nb)").select("a", "b").distinct()
    left, right = (sets.select(F.col("doc_id").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ab")
    shared = near.join(left, "a").join(right, "b").select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("both"))
    return shared.where(f"100 * both >= {similarity} * (na + nb - both)").select("a", "b")


def _links_across(sets: DataFrame, labels: DataFrame, members: DataFrame, similarity: int) -> DataFrame:
    """All links between nodes of different components that share a band bucket."""
    spark = sets.sparkSession
    placed = members.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").select("rep", "key", F.coalesce("label", "rep").alias("label"))
    mixed = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    open_nodes = stored(placed.join(stored(mixed, "mixed-keys"), "key", "left_semi").select(F.col("rep").alias("doc_id"), "label").distinct(), "open")
    chosen = sets.join(open_nodes, "doc_id").select("doc_id", "label", "shingles")
    counted = chosen.select("shingles").mapInArrow(_cell_counts, "cell long, count long").groupBy("cell").agg(F.sum("count").alias("count")).toPandas()
    frequency = np.zeros(CELLS, dtype=np.int64)
    frequency[counted["cell"].to_numpy()] = counted["count"].to_numpy()
    rows = stored(chosen.mapInArrow(_prefixes(frequency, similarity), "id long, label long, n long, place long, shingle long"), "prefixes")
    lone = rows.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("shingle")
    rows = rows.join(lone, "shingle", "left_semi")
    short = rows.where(f"place <= n - ceil({2 * similarity} * n / {100 + similarity})")
    index, probe = (frame.select(*(F.col(c).alias(f"{c}_{k}") for c in ("id", "label", "n", "place")), "shingle") for frame, k in ((short, "a"), (rows, "b")))
    fits = f"""label_a <> label_b and (n_a < n_b or (n_a = n_b and id_a < id_b)) and 100 * n_a >= {similarity} * n_b
        and {100 + similarity} * least(n_a - place_a, n_b - place_b) >= {similarity} * (n_a + n_b)"""
    pairs = index.join(probe, (index["shingle"] == probe["shingle"]) & F.expr(fits)).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    return _verified(stored(pairs, "pairs"), sets, similarity)


def near_duplicates(documents: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable by links) and kept.

    ``kept`` is true for the least id of each component. Rows with equal ids are one node with several texts. A row
    without an id is not linked: component_id is null and it is kept. An empty table gives no rows. ``similarity`` is
    in hundredths; banding is laid out for 80 and more.
    """
    docs = documents_of(documents)
    sketches = stored(docs.mapInArrow(_sketched, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"), "sketches")
    full = sketches.where("n_shingles > 0 and doc_id is not null")
    reps = stored(full.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep")), "sets")
    assigned = full.join(reps, ["set_a", "set_b"])
    # Near copies share keys, so a key may hold a third of all nodes: what it is joined with is stored, and the join's result
    # needs no placement, so that Spark splits the rows of such a key over tasks.
    entries = assigned.where("doc_id = rep").dropDuplicates(["set_a", "set_b"]).select("rep", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last")).where("center < last").select("key", "center")
    members = stored(entries.join(stored(shared, "shared-keys"), "key"), "members")
    ids = stored(members.select(F.col("rep").alias("doc_id")).distinct(), "candidates")
    sets = stored(only_ids(docs, ids, ["doc_id"]).mapInArrow(_sets, "doc_id long, n long, shingles array<long>").where("n > 0"), "shingles")
    stars = members.where("rep <> center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    # An id with several texts joins the nodes of all of them.
    joined = assigned.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("doc_id")
    same = assigned.join(joined, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    links = stored(_verified(stars, sets, similarity).union(same), "links")
    labels = components(links)
    links = links.union(_links_across(sets, labels, members, similarity))
    labels = components(links)
    rep_of = reps.join(labels, F.col("rep") == F.col("node"), "left").select("set_a", "set_b", F.coalesce("label", "rep").alias("component"))
    return (
        sketches.join(rep_of, ["set_a", "set_b"], "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one_each(documents: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The documents without near duplicates: of each component the one with the least id, unchanged.

    Of rows with equal ids the one with the least text stays; rows without an id all stay.
    """
    result = stored(near_duplicates(documents, similarity), "near")
    gone = stored(result.where("not kept").select("doc_id").distinct(), "gone")
    kept = only_ids(documents, gone, ["doc_id"], "left_anti")
    repeated = stored(result.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    single = only_ids(kept, repeated, ["doc_id"], "left_anti")
    several = only_ids(kept, repeated, ["doc_id"])
    fields = F.struct(*(kept[c] for c in ["text", *(c for c in kept.columns if c != "text")]))
    chosen = several.groupBy("doc_id").agg(F.min(fields).alias("row")).select(*(F.col(f"row.{c}").alias(c) for c in kept.columns))
    return single.union(chosen)
