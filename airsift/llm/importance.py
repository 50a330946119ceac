"""Importance resampling towards a target: hashed n-gram counts of two collections give each feature's gain, a document's
weight is the sum of its gains, and the documents with the highest weight plus Gumbel noise are drawn.

An untrained ``tokenizers`` pre-tokeniser splits the ASCII-lowered text by a regular expression and returns each word
with its offsets. A feature is a run of one to three words: a pair of offsets into the words joined by one space. Its
bucket is the CRC-32 of that slice modulo ``BUCKETS``. Every document's features are kept as 16-bit bucket numbers, so
texts are split once; counts per bucket (10,000 numbers a task) and the gains (10,000 numbers) are all that travels.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from airsift.llm import textbatch as tb
from airsift.llm.ranks import numbered
from airsift.llm.store import documents_of, stored

# Words are runs of lower-case letters, digits and everything beyond ASCII.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST_RUN = 3
BUCKETS = 10_000
SEED = 42
LEAST_WORDS = 20
DRAWN_PERCENT = 5

FEATURES = "doc_id long, n_words long, buckets binary"
COUNTS = "bucket int, n long"


def splitter(between: str = BETWEEN_WORDS) -> pre_tokenizers.PreTokenizer:
    return pre_tokenizers.Split(Regex(between), behavior="removed")


def lowered(text: str) -> str:
    """A-Z in lower case, nothing else changed (``bytes.lower`` knows ASCII only)."""
    return text.encode().lower().decode()


def feature_buckets(text: str, split: pre_tokenizers.PreTokenizer, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words and the bucket of every run of one to ``longest`` words."""
    found = split.pre_tokenize_str(lowered(text))
    held = " ".join([word for word, _ in found]).encode()
    # The joined words' offsets in bytes: each word's place is the sum of those before it.
    ends = [0] * len(found)
    place = -1
    for k, (word, (first, last)) in enumerate(found):
        place += 1 + (last - first if word.isascii() else len(word.encode()))
        ends[k] = place
    starts = [0, *(end + 1 for end in ends[:-1])]
    values = [crc32(held[a:b]) for run in range(1, longest + 1) for a, b in zip(starts, ends[run - 1 :])]
    return len(found), (np.array(values, dtype=np.uint32) % np.uint32(buckets)).astype("<u2")


def _features(longest: int, buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        for chunk in tb.chunks(batches):
            found = [feature_buckets(text or "", split, longest, buckets) for text in chunk.column("text").to_pylist()]
            arrays = [chunk.column("doc_id"), pa.array([words for words, _ in found], pa.int64()), pa.array([own.tobytes() for _, own in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "buckets"])

    return rows


def features(documents: DataFrame, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> DataFrame:
    """Rows (doc_id, n_words, buckets): the bucket of each run of words as little-endian 16-bit numbers; null texts are empty."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are kept in 16 bits")
    return documents_of(documents).mapInArrow(_features(longest, buckets), FEATURES)


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All features of a batch, and the bounds of each row's."""
    column = batch.column(batch.schema.get_field_index("buckets")).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return data.view("<u2"), (bounds - bounds[0]) // 2


def _counted(buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch)[0], minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], names=["bucket", "n"])

    return rows


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, n) over all documents, at most ``buckets``; each task hands on one row a bucket."""
    return found.select("buckets").mapInArrow(_counted(buckets), COUNTS).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, gain) for every bucket: floor of 1,000 times the log ratio of its smoothed shares in target and corpus."""
    spark = corpus.sparkSession
    totals = corpus.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("s_all")).first()[0], target.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    s, t = (F.coalesce(F.col(name), F.lit(0)).cast("double") for name in ("s", "t"))
    ratio = ((t + 1.0) * F.lit(float(totals[0] + buckets))) / ((s + 1.0) * F.lit(float(totals[1] + buckets)))
    return both.select("bucket", F.floor(1000.0 * F.log(ratio)).cast("long").alias("gain"))


def _weighed(gain: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, bounds = _numbers(batch)
            sums = np.append(0, np.cumsum(gain[numbers]))
            arrays = [
                batch.column(batch.schema.get_field_index("doc_id")),
                batch.column(batch.schema.get_field_index("n_words")),
                pa.array(np.diff(bounds)),
                pa.array(sums[bounds[1:]] - sums[bounds[:-1]]),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight"])

    return rows


def noise(doc_id, seed: int):
    """Gumbel noise in thousandths, floored, from the first 32 bits of the SHA-256 of ``seed:doc_id``; null without an id."""
    head = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((head + 0.5) / 4294967296.0))).cast("long")


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score and rank (1, 2, 3, … of the drawn ones, else null).

    Drawn are ``floor(percent * N / 100)`` of the N documents with at least ``least_words`` words: those of the highest
    score, ties by the smaller doc_id. ``target`` is a table with a column ``text``. Texts are used whole; null and
    empty ones have no features and weight 0. A row without an id has no noise, so no score: it counts towards the
    corpus, but is neither among the N nor drawn. Rows that share an id are drawn each by its own score; their order is
    by weight, then features where the scores tie. An empty corpus gives no rows; with an empty target all gains come
    from smoothing. Other columns are ignored.
    """
    found = stored(features(documents, longest, buckets), "features")
    wanted = features(target.select(F.lit(0).alias("doc_id"), "text"), longest, buckets)
    corpus = stored(bucket_counts(found, buckets), "corpus-buckets")
    aim = stored(bucket_counts(wanted, buckets), "target-buckets")
    gain = np.zeros(buckets, dtype=np.int64)
    for row in gains(corpus, aim, buckets).collect():  # one row a bucket
        gain[row["bucket"]] = row["gain"]
    weighed = found.mapInArrow(_weighed(gain), "doc_id long, n_words long, n_features long, weight long")
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    order = [F.col("score").desc(), F.col("doc_id"), F.col("weight").desc(), F.col("n_features").desc()]
    ranked = numbered(scored.where(able), order, purpose="draws")
    drawn = F.when(F.col("position") * 100 < F.expr(f"{percent} * total div 100 * 100"), F.col("position") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(~F.coalesce(able, F.lit(False))).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, drawn.alias("rank")).union(rest)


def oracle() -> str:
    """The registered query in SQL. CRC-32 goes byte by byte over a table of 256 remainders."""
    remainder = "list_reduce(list_concat([k], range(8)), lambda c, e: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    return f"""
WITH remainders AS (
    SELECT list(r ORDER BY k) AS rest FROM (SELECT k, {remainder} AS r FROM (SELECT unnest(range(256)) AS k))
), texts AS (
    SELECT row_number() OVER () AS place, true AS target, NULL::bigint AS doc_id, text FROM benchmark
    UNION ALL SELECT row_number() OVER (), false, doc_id, text FROM documents
), split AS (
    SELECT target, place, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM texts
), runs AS (
    SELECT target, place, unnest(list_transform(range(1, len(w) + 2 - n), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS run
    FROM split, (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n
), counted AS (
    SELECT target, place, run, count(*) AS n FROM runs GROUP BY ALL
), bytes AS (
    SELECT run, hex(encode(run)) AS h FROM (SELECT DISTINCT run FROM counted)
), hashed AS (
    SELECT run, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::bigint)),
        lambda c, b: xor(c // 256, rest[xor(c % 256, b) + 1])), 4294967295) % {BUCKETS} AS bucket
    FROM bytes, remainders
), features AS (
    SELECT target, place, bucket, n FROM counted JOIN hashed USING (run)
), sums AS (
    SELECT bucket, coalesce(sum(n) FILTER (NOT target), 0)::double AS s, coalesce(sum(n) FILTER (target), 0)::double AS t FROM features GROUP BY bucket
), totals AS (
    SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums
), gained AS (
    SELECT bucket, floor(1000 * ln((t + 1) * (s_all + {BUCKETS}) / ((s + 1) * (t_all + {BUCKETS}))))::bigint AS gain FROM sums, totals
), weighed AS (
    SELECT place, sum(n)::bigint AS n_features, sum(n * gain)::bigint AS weight FROM features JOIN gained USING (bucket) WHERE NOT target GROUP BY place
), scored AS (
    SELECT p.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS n_words,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('{SEED}:' || p.doc_id), 8))::bigint + 0.5) / 4294967296)))::bigint AS score
    FROM split p LEFT JOIN weighed USING (place) WHERE NOT p.target
), able AS (
    SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS total FROM scored WHERE n_words >= {LEAST_WORDS} AND score IS NOT NULL
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= {DRAWN_PERCENT} * total // 100 THEN r END AS rank FROM able
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_words < {LEAST_WORDS} OR score IS NULL
"""
