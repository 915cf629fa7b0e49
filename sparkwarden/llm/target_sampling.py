"""Importance resampling towards a target: documents are drawn by how much more likely the target's features are.

1. Features are words and pairs of neighbouring words, hashed into ``BUCKETS`` buckets by CRC-32. One pass counts the
   buckets of the corpus, one those of the target; each task adds up its own array, so 10,000 rows leave a task.
2. The gain of a bucket is the logarithm of its smoothed share in the target over that in the corpus. The array of gains
   goes to all tasks, and a second pass gives each document the floored mean of its features' gains, its weight. The
   score adds Gumbel noise, from a hash of the id: the highest scores are a draw without replacement.
3. Scores are written once. The cutoff of the wanted number of rows is found by bisection: count jobs over the written
   scores, each at ``CUTS`` thresholds, first on the score, then on the doc_id among the rows tied there, then on the
   row number among rows that share both. Nothing is sorted for that, and no group of ties meets in a task.
4. Only the drawn rows are range-partitioned and sorted. A row's rank is its place in its range plus the sizes of the
   ranges before it.

Words and CRCs are worked out for a whole batch at once: registers of all words advance byte by byte together.

Defined results: null and empty texts have no features, weight 0 and a score, and are not drawn. A null doc_id has the
noise of an empty id and loses ties. Rows that repeat a doc_id and score are drawn as single rows, in any order among
themselves. Long texts are read whole, in blocks of words. Extra columns are not looked at; ``resample`` returns them.
An empty target gives every bucket the gain of no occurrence; empty documents give an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwarden.llm.common import by_bytes, prepare, table
from sparkwarden.session import materialize

BUCKETS = 10_000
PERCENT, LEAST_WORDS, SEED = 25, 20, 7
# Thresholds of one count job, words that are hashed at once, bytes of a word that are hashed with the others.
CUTS, BLOCK, LONG = 15, 1 << 20, 48
_LAST = (1 << 63) - 1


def _crc_table() -> np.ndarray:
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, (row >> 1) ^ np.uint32(0xEDB88320), row >> 1)
    return row


_TABLE = _crc_table()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.array([48 <= b < 58 or 97 <= b < 123 or b >= 128 for b in range(256)])


def _advance(register: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC registers after ``size`` more bytes from ``start``."""
    order = np.argsort(-size, kind="stable")
    now, place = register[order], start[order]
    longer = np.cumsum(np.bincount(np.minimum(size, LONG), minlength=LONG + 1)[::-1])[::-1]
    for k in range(LONG):
        n = longer[k + 1]
        if not n:
            break
        head = now[:n]
        now[:n] = _TABLE[(head ^ data[place[:n] + k]) & np.uint32(255)] ^ (head >> np.uint32(8))
    out = np.empty_like(register)
    out[order] = now
    for i in np.flatnonzero(size > LONG):
        rest = data[start[i] + LONG : start[i] + size[i]].tobytes()
        out[i] = zlib.crc32(rest, int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return out


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Blocks of features of some texts: the text that each belongs to, its bucket, and how many of them are words."""
    column = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return
    data = _LOWER[np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]]
    edges = offsets - offsets[0]
    inside = _IN_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges[:-1][edges[:-1] < len(data)]] = True
    start = np.flatnonzero(begins & inside)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges[1:][edges[1:] > 0] - 1] = True
    size = np.flatnonzero(ends & inside) + 1 - start
    owner = np.searchsorted(edges, start, side="right") - 1
    first = np.uint32(0xFFFFFFFF)
    for at in range(0, len(start), BLOCK):
        # One word more, for the pair of a block's last word.
        here = slice(at, min(at + BLOCK + 1, len(start)))
        place, length, of = start[here], size[here], owner[here]
        single = _advance(np.full(len(place), first), data, place, length)
        left = np.flatnonzero(of[1:] == of[:-1])
        spaced = single[left]
        spaced = _TABLE[(spaced ^ np.uint32(32)) & np.uint32(255)] ^ (spaced >> np.uint32(8))
        pairs = _advance(spaced, data, place[left + 1], length[left + 1])
        n = min(BLOCK, len(place))
        buckets = np.concatenate([single[:n], pairs]) ^ first
        yield np.concatenate([of[:n], of[left]]), (buckets % np.uint32(BUCKETS)).astype(np.int64), n


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        texts = batch.column(0)
        for start, end in by_bytes(texts):
            for _, buckets, _ in features(texts.slice(start, end - start)):
                counts += np.bincount(buckets, minlength=BUCKETS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    prepare(docs.sparkSession)
    parts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_counting, "bucket long, n long")
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():  # ``BUCKETS`` rows at most
        counts[bucket] = n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of smoothed shares, target over corpus, floored."""
    s_all, t_all = float(int(corpus.sum()) + BUCKETS), float(int(target.sum()) + BUCKETS)
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in pairs], dtype=np.int64)


def _weighing(gain: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for start, end in by_bytes(texts):
                n = end - start
                total, number, words = (np.zeros(n, dtype=np.int64) for _ in range(3))
                for owner, buckets, singles in features(texts.slice(start, n)):
                    # Sums of whole numbers far below 2 ** 53 are exact in doubles.
                    total += np.bincount(owner, gain[buckets], minlength=n).astype(np.int64)
                    number += np.bincount(owner, minlength=n)
                    words += np.bincount(owner[:singles], minlength=n)
                weight = np.where(number > 0, total // np.maximum(number, 1), 0)
                columns = [c.slice(start, n) for c in batch.columns[:-1]] + [pa.array(x) for x in (words, number, weight)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel number from the id's hash, floored."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def scored(docs: DataFrame, gain: np.ndarray, keep: list[str], seed: int = SEED) -> DataFrame:
    """``kept`` (the columns ``keep``), ``id``, ``n_words``, ``n_features``, ``weight``, ``score``, and ``row``.

    ``row`` tells equal rows apart once the result has been written.
    """
    prepare(docs.sparkSession)
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")
    chosen = docs.select(kept, F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    added = T.StructType.fromDDL("n_words long, n_features long, weight long")
    schema = T.StructType(chosen.schema.fields[:2] + added.fields)
    rows = chosen.mapInArrow(_weighing(gain), schema)
    return rows.withColumn("score", F.col("weight") + noise(F.col("id"), seed)).withColumn("row", F.monotonically_increasing_id())


def smallest(rows: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The ``k``-th smallest value of a column of whole numbers, and how many rows lie below it.

    Each job counts the rows up to ``CUTS`` values between the bounds, which then close in around the wanted one.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    below = 0
    while low < high:
        step = max((high - low) // (CUTS + 1), 1)
        cuts = [low + i * step for i in range(CUTS) if low + i * step < high]
        found = rows.agg(*[F.count(F.when(F.col(column) <= c, 1)) for c in cuts]).first()
        for cut, n in zip(cuts, found, strict=True):
            if n >= k:
                high = cut
                break
            low, below = cut + 1, n
    return low, below


def drawn(rows: DataFrame, k: int) -> Column:
    """Whether a row of written scores is one of the ``k`` first by score, falling, and id, rising."""
    if k <= 0:
        return F.lit(False)
    found: Column | None = None
    tied = F.lit(True)
    order = rows.select((-F.col("score")).alias("score"), F.coalesce("id", F.lit(_LAST)).alias("id"), "row")
    for column, value in (("score", -F.col("score")), ("id", F.coalesce("id", F.lit(_LAST))), ("row", F.col("row"))):
        cut, below = smallest(order, column, k)
        before = tied & (value < cut)
        found = before if found is None else found | before
        tied, k = tied & (value == cut), k - below
        order = order.where(F.col(column) == cut)
    return found | tied


def ranked(rows: DataFrame) -> DataFrame:
    """Rows with ``rank`` by score, falling, and id, rising: the place in a range, after all ranges before it."""
    keys = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")]
    ranges = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(ranges.withColumn("at", F.monotonically_increasing_id()), "ranges")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).count().orderBy("part").collect()  # one row for each range
    before, passed = [], 0
    for r in sizes:
        before += [F.lit(r["part"]), F.lit(passed)]
        passed += r["count"]
    offset = F.create_map(*before)[part] if before else F.lit(0)
    return placed.withColumn("rank", (offset + place + 1).cast("long")).drop("at")


def select(docs: DataFrame, target: DataFrame, keep: list[str], percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Drawn rows with their ``rank``, and all others; columns as in ``scored``."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows = materialize(scored(docs, gain, keep, seed), "scores")
    able = rows.where(F.col("n_words") >= least_words)
    is_drawn = (F.col("n_words") >= least_words) & drawn(able, percent * able.count() // 100)
    return ranked(rows.where(is_drawn)), rows.where(~is_drawn)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns."""
    taken, _ = select(docs, target, docs.columns, percent, least_words, seed)
    return taken.select("kept.*")


def op11_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    taken, rest = select(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])
    columns = ["kept.doc_id", "n_features", "weight", "score"]
    return taken.select(*columns, "rank").union(rest.select(*columns, F.lit(None).cast("long").alias("rank")))

