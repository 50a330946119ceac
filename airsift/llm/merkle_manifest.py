"""Merkle manifest of a table: a tree of digests per source, a tree of those over all sources, and proofs of every row.

Every ``ARITY`` = 3 consecutive nodes have the digest of their joined digests as parent, the last run of a level may be
shorter, until one node remains. Trees are cut into *blocks*: aligned subtrees of ``BLOCK_HEIGHT`` levels, 729 leaves at
most. Block roots are the leaves of the next tier of blocks, so a tree of n leaves has log(n) / log(729) tiers, and a
group of rows is bounded however large a source is.

In a block the digests stand in van Emde Boas order: a tree of L levels is split at half height into a top of L // 2
levels, stored first, and its bottom subtrees, each stored in one piece and split alike. ``addresses`` computes where a
node stands; building a block and reading a node's siblings go through it, so what a path touches lies close together at
every scale. Built blocks are stored as rows. Proofs go down from the top tier: each block gets what stands beside the
path from its root to the top, and hands each of its leaves that and its own siblings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift.llm.ranks import numbered
from airsift.llm.store import small_batches, stored

ARITY = 3
BLOCK_HEIGHT = 6
DIGEST = 64  # hex digits

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

# total: nodes of the block's tree in its tier; payload: what leaves carry along, absent above the lowest tier.
BLOCKS = "tree string, block long, total long, leaves int, height int, nodes binary, payload array<struct<doc_id:bigint,given:string>>"
STEPS = "array<struct<left:string,right:string>>"
ABOVE = f"tree string, block long, subroot string, above {STEPS}"
PROVEN = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def encoded(value: Column) -> Column:
    """A field as it enters a leaf: ``-`` if null, else its length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*(encoded(value) for value in fields.values())), 256)


def nodes_of(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


@cache
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Van Emde Boas address of every node of a full tree: one array per depth, from the root, by place in the level."""
    if levels == 1:
        return (np.zeros(1, dtype=np.int64),)
    top = levels // 2
    upper, lower = addresses(top), addresses(levels - top)
    size = nodes_of(levels - top)
    found = list(upper)
    for depth, inside in enumerate(lower):
        subtree = np.repeat(np.arange(ARITY**top), ARITY**depth)
        found.append(nodes_of(top) + subtree * size + np.tile(inside, ARITY**top))
    return tuple(found)


def height_of(leaves: int) -> int:
    """Levels above the leaves of a tree that ends where one node remains."""
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // ARITY), height + 1
    return height


def digest(joined: bytes) -> bytes:
    return hashlib.sha256(joined).hexdigest().encode()


class Block:
    """The digests of one block in van Emde Boas order; absent nodes of a partly filled block are empty places."""

    def __init__(self, leaves: int, height: int, nodes: bytes | bytearray):
        self.leaves, self.height, self.nodes, self.at = leaves, height, nodes, addresses(height + 1)

    @classmethod
    def of(cls, digests: list[bytes], height: int) -> Block:
        block = cls(len(digests), height, bytearray(DIGEST * nodes_of(height + 1)))
        for place, value in zip(block.at[height].tolist(), digests):
            block.nodes[DIGEST * place : DIGEST * (place + 1)] = value
        for level in range(1, height + 1):
            here = block.at[height - level]
            for place in range(block.width(level)):
                at = DIGEST * int(here[place])
                block.nodes[at : at + DIGEST] = digest(b"".join(block.node(level - 1, child) for child in block.run(level - 1, place)))
        return block

    def width(self, level: int) -> int:
        """Nodes that are there, ``level`` levels above the leaves."""
        return -(-self.leaves // ARITY**level)

    def run(self, level: int, parent: int) -> range:
        return range(ARITY * parent, min(ARITY * (parent + 1), self.width(level)))

    def node(self, level: int, place: int) -> bytes:
        at = DIGEST * int(self.at[self.height - level][place])
        return bytes(self.nodes[at : at + DIGEST])

    def root(self) -> bytes:
        return self.node(self.height, 0)

    def beside(self, place: int) -> list[tuple[bytes, bytes]]:
        """What stands left and right of a leaf's path, level by level up to the block's root."""
        out = []
        for level in range(self.height):
            run = self.run(level, place // ARITY)
            left = b"".join(self.node(level, other) for other in run if other < place)
            out.append((left, b"".join(self.node(level, other) for other in run if other > place)))
            place //= ARITY
        return out


def _built(block_height: int):
    """Rows (tree, block, total, members) to blocks; members are (position, digest, doc_id, given), in order."""
    payload = pa.list_(pa.struct([("doc_id", pa.int64()), ("given", pa.string())]))
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), payload]
    names = [field.split()[0] for field in BLOCKS.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                members = row["members"]
                # A block among others is lifted to full height; one that is the whole tree ends where one node remains.
                height = block_height if row["total"] > ARITY**block_height else height_of(len(members))
                block = Block.of([member["digest"].encode() for member in members], height)
                carried = [{"doc_id": member["doc_id"], "given": member["given"]} for member in members]
                values = [row["tree"], row["block"], row["total"], len(members), height, bytes(block.nodes), carried]
                yield pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(values, types)], names=names)

    return rows


def _root() -> Column:
    """The root of a stored block: its order begins with it."""
    return F.decode(F.substring("nodes", 1, DIGEST), "UTF-8")


def forest(nodes: DataFrame, block_height: int, purpose: str) -> list[DataFrame]:
    """Stored tiers of blocks over nodes (tree, position, total, digest, doc_id, given); the last has one block per tree.

    A tree that is one block already is a tree of one node in the tiers above, which is its own root.
    """
    size = ARITY**block_height
    tiers = []
    while True:
        members = F.array_sort(F.collect_list(F.struct("position", "digest", "doc_id", "given"))).alias("members")
        grouped = nodes.groupBy("tree", F.expr(f"position div {size}").alias("block")).agg(F.max("total").alias("total"), members)
        blocks = stored(small_batches(grouped).mapInArrow(_built(block_height), BLOCKS), f"{purpose}-tier{len(tiers)}")
        tiers.append(blocks)
        if blocks.where(F.col("total") > size).isEmpty():
            return tiers
        above = F.expr(f"(total + {size - 1}) div {size}").alias("total")
        nothing = [F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("given")]
        nodes = blocks.select("tree", F.col("block").alias("position"), above, _root().alias("digest"), *nothing)


def _with_above(blocks: DataFrame, above: DataFrame) -> DataFrame:
    beside = above.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "subroot", "above")
    same = blocks["tree"].eqNullSafe(beside["_tree"]) & (blocks["block"] == beside["_block"])
    return small_batches(blocks.join(beside, same).drop("_tree", "_block"))


def _steps(row: dict) -> list[tuple[bytes, bytes]]:
    return [(step["left"].encode(), step["right"].encode()) for step in row["above"]]


def _below(block_height: int):
    """A block and what stands beside the path above it, to the same for each of its leaves."""
    steps = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, upper = Block(row["leaves"], row["height"], row["nodes"]), _steps(row)
                beside = [[{"left": a.decode(), "right": b.decode()} for a, b in block.beside(place) + upper] for place in range(block.leaves)]
                first = row["block"] * ARITY**block_height
                arrays = [
                    pa.array([row["tree"]] * block.leaves, pa.string()),
                    pa.array(range(first, first + block.leaves), pa.int64()),
                    pa.array([row["subroot"]] * block.leaves, pa.string()),
                    pa.array(beside, steps),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["tree", "block", "subroot", "above"])

    return rows


def paths(tiers: list[DataFrame], above: DataFrame, lowest: int, block_height: int, purpose: str) -> DataFrame:
    """What stands beside the paths above the nodes of tier ``lowest``, from that of the one block of each tree (``above``)."""
    for tier in range(len(tiers) - 1, lowest - 1, -1):
        above = stored(_with_above(tiers[tier], above).mapInArrow(_below(block_height), ABOVE), f"{purpose}-above{tier}")
    return above


def _proven(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block of leaves and what stands beside the path above it, to a row per leaf."""
    for batch in batches:
        for row in batch.to_pylist():
            block, above = Block(row["leaves"], row["height"], row["nodes"]), _steps(row)
            upper = b"".join(left + right for left, right in above)
            out = []
            for place, member in enumerate(row["payload"]):
                own = block.beside(place)
                proof = hashlib.sha256(b"".join(left + right for left, right in own) + upper).hexdigest()
                folded = member["given"].encode()
                for left, right in own + above:
                    folded = digest(left + folded + right)
                out.append((member["doc_id"], block.node(0, place).decode(), row["subroot"], proof, folded.decode()))
            columns = list(zip(*out))
            arrays = [pa.array(columns[0], pa.int64()), *(pa.array(values, pa.string()) for values in columns[1:])]
            yield pa.RecordBatch.from_arrays(arrays, names=[field.split()[0] for field in PROVEN.split(", ")])


def manifest(
    documents: DataFrame, found_later: Callable[[dict[str, Column]], dict[str, Column]] | None = None, block_height: int = BLOCK_HEIGHT
) -> DataFrame:
    """One row per row of the table: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    A leaf is the digest of ``FIELDS``. Per source, leaves ascend by doc_id (null first; rows of one id by their
    leaves, so that the manifest does not depend on how rows are stored) and make a tree with root ``subroot``; the
    subroots, ordered by source (null first, else by UTF-8 bytes), make a tree with root ``root``. ``proof_sha256`` is the
    digest of a leaf's joined siblings up to the root. ``folded_root`` is computed anew from those siblings and the
    leaf of ``found_later(fields)``, the fields as they are to be checked (unchanged if not given); ``verified`` says
    whether it still is the root.

    Texts are hashed whole by Spark's own functions. Equal rows are leaves of their own, in any order. A missing column
    counts as null; others than ``FIELDS`` are ignored. An empty table gives no rows.
    """
    types = {"doc_id": "long", "n_chars": "long"}
    fields = {name: (F.col(name) if name in documents.columns else F.lit(None)).cast(types.get(name, "string")) for name in FIELDS}
    given = leaf(found_later(fields)) if found_later else leaf(fields)
    rows = stored(documents.select(fields["source"].alias("tree"), fields["doc_id"].alias("doc_id"), leaf(fields).alias("digest"), given.alias("given")), "leaves")
    leaves = numbered(rows, [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("given")], "tree", "leaf-order")
    by_source = forest(leaves, block_height, "sources")

    subroots = by_source[-1].select("tree", _root().alias("digest"))
    sources = numbered(subroots.withColumnRenamed("tree", "source"), [F.col("source").asc_nulls_first()], None, "source-order")
    nothing = [F.lit(None).cast("string").alias(name) for name in ("tree", "given")]
    over_all = forest(sources.select("position", "total", "digest", F.lit(None).cast("long").alias("doc_id"), *nothing), block_height, "all")
    root = F.lit(next((row[0] for row in over_all[-1].select(_root()).collect()), None)).cast("string")  # one digest

    top = over_all[-1].select("tree", "block", F.lit(None).cast("string").alias("subroot"), F.array().cast(STEPS).alias("above"))
    above_sources = paths(over_all, top, 0, block_height, "all")
    named = sources.join(above_sources.select("block", "above"), F.col("position") == F.col("block"))
    start = stored(named.select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("block"), F.col("digest").alias("subroot"), "above"), "above-sources")
    proven = _with_above(by_source[0], paths(by_source, start, 1, block_height, "sources")).mapInArrow(_proven, PROVEN)
    return proven.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def without_line_breaks(fields: dict[str, Column]) -> dict[str, Column]:
    """The tampering of the registered query: every second document (by the CRC-32 of its id) loses its line breaks."""
    chosen = F.crc32(fields["doc_id"].cast("string")) % 2 == 0
    return fields | {"text": F.when(chosen, F.replace(fields["text"], F.lit("\n"), F.lit(""))).otherwise(fields["text"])}


def oracle() -> str:
    """The registered query in SQL, level by level from the leaves of all documents."""
    field = "coalesce(strlen({0}::varchar) || ':' || {0}, '-')"
    joined = " || ".join(field.format(name) for name in FIELDS[:-1])
    # CRC-32 bit by bit: a byte is mixed in, then eight shifts (marked -1).
    crc = (
        "xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length(doc_id::varchar) + 1), "
        "lambda k: [ascii(substr(doc_id::varchar, k::bigint, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295)"
    )
    return f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, sha256({joined} || {field.format("text")}) AS leaf,
        sha256({joined} || {field.format("given")}) AS given_leaf
    FROM (SELECT *, CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS given FROM documents)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, given_leaf) - 1 AS place,
        count(*) OVER (PARTITION BY source) AS total
    FROM leaves
), nodes(source, level, place, total, digest) AS (
    SELECT source, 0, place, total, leaf FROM placed
    UNION ALL
    SELECT source, level + 1, place // 3, (any_value(total) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE total > 1 GROUP BY source, level, place // 3
), subroots AS (
    SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS total FROM nodes WHERE total = 1
), upper(level, place, total, digest) AS (
    SELECT 0, place, total, digest FROM subroots
    UNION ALL
    SELECT level + 1, place // 3, (any_value(total) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM upper WHERE total > 1 GROUP BY level, place // 3
), beside AS (
    SELECT p.source, p.place, n.level AS step,
        coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place < p.place // (3 ** n.level)::bigint), '') AS l,
        coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place > p.place // (3 ** n.level)::bigint), '') AS r
    FROM placed p JOIN nodes n ON n.source IS NOT DISTINCT FROM p.source AND n.total > 1
        AND n.place // 3 = p.place // (3 ** (n.level + 1))::bigint
    GROUP BY p.source, p.place, n.level
    UNION ALL
    SELECT p.source, p.place, 1000 + u.level,
        coalesce(string_agg(u.digest, '' ORDER BY u.place) FILTER (u.place < s.place // (3 ** u.level)::bigint), ''),
        coalesce(string_agg(u.digest, '' ORDER BY u.place) FILTER (u.place > s.place // (3 ** u.level)::bigint), '')
    FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
        JOIN upper u ON u.total > 1 AND u.place // 3 = s.place // (3 ** (u.level + 1))::bigint
    GROUP BY p.source, p.place, u.level
), proofs AS (
    SELECT source, place, sha256(string_agg(l || r, '' ORDER BY step)) AS proof, list(l ORDER BY step) AS ls, list(r ORDER BY step) AS rs
    FROM beside GROUP BY source, place
), folded(source, place, step, digest, ls, rs) AS (
    SELECT p.source, p.place, 1, p.given_leaf, ls, rs FROM placed p LEFT JOIN proofs q ON q.source IS NOT DISTINCT FROM p.source AND q.place = p.place
    UNION ALL
    SELECT source, place, step + 1, sha256(ls[step] || digest || rs[step]), ls, rs FROM folded WHERE step <= len(ls)
)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
    f.digest AS folded_root, f.digest = r.digest AS verified
FROM placed p
JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
JOIN folded f ON f.source IS NOT DISTINCT FROM p.source AND f.place = p.place AND f.step = coalesce(len(f.ls), 0) + 1
LEFT JOIN proofs q ON q.source IS NOT DISTINCT FROM p.source AND q.place = p.place
CROSS JOIN (SELECT digest FROM upper WHERE total = 1) r
"""
