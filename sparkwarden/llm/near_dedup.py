"""Near-duplicate texts by bottom-k sketches from one hash function.

A document's set are the hashes of its distinct shingles of five words. The ``LISTED`` least of them are its sketch for
inverted lists; the ``SKETCH`` least, of documents that meet anybody, estimate overlaps.

1. Texts that are equal byte for byte are one node from here on.
2. Inverted lists. Two similar sets share most of their sketches, so it is enough to list a document under its rarest
   retained values (all but so many that a similar one cannot hold only those). Common passages fall out of the lists
   by themselves, unless a document consists of little else.
3. Each list links its members to its centre, the one whose values are the most common: a link for a member, not one
   for a pair. Links that the union sketch does not rule out are verified on the full sets, and verified links give
   components.
4. Lists that still hold several components are compared inside tasks, members of different components only, by shared
   values, each pair in the first list in which it meets; long lists are cut into blocks that meet pairwise. Where the
   sketches are whole sets the link is decided there, and only links that join two components leave the task. All other
   pairs that can be similar leave it, are verified in the same way, and join the components.

The full sets decide every link. What may fail is only the meeting: two sets right at the threshold share under
``_shared`` of the 64 least values of their union (36 at 0.85, 31 at 0.80) less than once in a hundred million, or under
``_floor`` (0.69 at 0.85) of the 256 least less than once in a billion. Sets of at most 64 or 256 shingles are compared whole and cannot fail.

Defined results: a null or empty text, or one without words, has an empty set and stays alone. Fewer than five words
are one shingle. Components carry the smallest doc_id of their rows; rows without doc_id belong to components but name
none, and a component of such rows only has a null id. Repeated rows are linked, and each is there once in the result.
A
similarity equal to the threshold links. Extra columns stay with their rows in ``keep_first``. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwarden.llm.common import LOWER, UPPER, packed, prepare, table, unpacked
from sparkwarden.llm.components import connected_components
from sparkwarden.llm.suffix_dedup import Hashes
from sparkwarden.session import discard, materialize

WORDS = 5
PERCENT = 85
LISTED, SKETCH = 64, 256
# The part of the pairs right at the threshold that may share less of their lists than ``_shared`` says.
LOSS = 1e-8
# Members that meet in one task; longer lists are cut into blocks of half as many.
CHUNK = 4096
_FEW, _COLUMNS = 24, 512
# Rows of a long list that are compared with all others at once, and pairs that a task holds before they leave it.
_ROWS, _PAIRS = 512, 16_384
# Keys of 16 bytes that are sent to all tasks to pick sets; with more, keys and sets meet by a shuffle.
KEYS = 500_000
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the distinct shingles, in order."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    h = Hashes(np.frombuffer(b" ".join(words), dtype=np.uint8))
    n = WORDS if len(words) >= WORDS else len(words)
    return np.unique(h.of(start[: len(words) - n + 1], end[n - 1 :]).view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _sets(least: int | None):
    """Of (key or id columns, text): the other columns, the size of the set, and its ``least`` hashes or all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = [shingles(t.as_buffer().to_pybytes()) if t.is_valid else np.zeros(0, np.int64) for t in texts]
            names = [*batch.schema.names[:-1], "n", "least"]
            rows = [*batch.columns[:-1], pa.array([len(f) for f in found], pa.int32()), _lists([f[:least] for f in found])]
            yield pa.RecordBatch.from_arrays(rows, names=names)
        pa.default_memory_pool().release_unused()

    return run


def _key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _shared(percent: int) -> int:
    """So many of the ``LISTED`` least values of their union two similar sets share, but for ``LOSS`` of the pairs."""
    part, shared = percent / 100, 0
    less = (1 - part) ** LISTED
    while shared < LISTED and less <= LOSS:
        shared += 1
        less += math.comb(LISTED, shared) * part**shared * (1 - part) ** (LISTED - shared)
    return shared


def _listed(sets: DataFrame, percent: int) -> DataFrame:
    """``value, key``: the rarest retained values of each document, those that anybody shares, and its ``weight``.

    The weight says how common a document's values are: the centre of a group of variants has the largest one.
    """
    values = sets.select("key", F.size("least").alias("kept"), F.explode("least").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("of")).where("of > 1")
    own = W.partitionBy("key")
    ranked = values.join(shared, "value").select(
        "key", "kept", "value", F.count("*").over(own).alias("met"),
        F.row_number().over(own.orderBy("of", "value")).alias("rank"), F.sum("of").over(own).alias("weight"),
    )
    # Values that nobody shares are the rarest of all: they stand before the others and meet nobody.
    common = F.least(F.ceil(F.col("kept") * percent / 100), F.lit(_shared(percent)))
    return ranked.where(F.col("rank") <= F.col("met") - common + 1).select("value", "key", "weight")


def _needed(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """The sets of some keys, left behind before the others are shuffled; up to ``KEYS`` keys travel for that."""
    keys = materialize(keys.distinct(), "keys")
    return sets.join(F.broadcast(keys) if keys.count() <= KEYS else keys, "key", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes, union sketch and full sets agree that they are similar."""
    pairs = _of_like_size(pairs, sets, percent)
    sets = _needed(sets, pairs.select(F.explode(F.array("a", "b")).alias("key")))
    x = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("least").alias("sa"))
    y = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("least").alias("sb"))
    both = pairs.join(x, "a").join(y, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    sketch_a, sketch_b = F.slice("sa", 1, SKETCH), F.slice("sb", 1, SKETCH)
    union = F.slice(F.sort_array(F.array_union(sketch_a, sketch_b)), 1, SKETCH)
    shared = F.size(F.array_intersect(union, F.array_intersect(sketch_a, sketch_b)))
    near = both.where(shared >= _floor(percent) * F.size(union)).withColumn("met", F.size(F.array_intersect("sa", "sb")))
    return near.where(100 * F.col("met") >= percent * (F.col("na") + F.col("nb") - F.col("met"))).select("a", "b")


def _of_like_size(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes allow the similarity, before any set moves."""
    x, y = (sets.select(F.col("key").alias(k), F.col("n").alias(f"n{k}")) for k in ("a", "b"))
    both = pairs.join(x, "a").join(y, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return materialize(both.select("a", "b"), "pairs")


def _floor(percent: int) -> float:
    """The least part of a union sketch that two similar sets share, but for seven standard deviations."""
    part = percent / 100
    return part - 7 * math.sqrt(part * (1 - part) / SKETCH)


class Joined:
    """Components that links of one list have joined."""

    def __init__(self) -> None:
        self.up: dict[bytes, bytes] = {}

    def _top(self, x: bytes) -> bytes:
        while (up := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(up, up)
            x = up
        return x

    def add(self, x: bytes, y: bytes) -> bool:
        """Whether a link between two components joins what was not joined before."""
        x, y = self._top(x), self._top(y)
        self.up[x] = y
        return x != y


def _compare(percent: int):
    """Pairs of different components that share enough of their sketches, from rows sorted by (value, i, j)."""
    floor = _floor(percent)

    def enough(shared, na, nb):
        """Whether two sets can be similar, and whether that is certain already."""
        whole = (na <= SKETCH) & (nb <= SKETCH)
        return np.where(whole, 100 * shared >= percent * (na + nb - shared), shared >= floor * SKETCH), whole

    def few(rows: list[tuple], value: int) -> Iterator[tuple[bytes, bytes]]:
        sets = [None] * len(rows)
        joined = Joined()
        for x, (key, comp, _, n, _, listed) in enumerate(rows):
            for y in range(x):
                other = rows[y]
                if other[1] == comp or 100 * min(n, other[3]) < percent * max(n, other[3]) or first_met(listed, other[5]) != value:
                    continue
                for z in (x, y):
                    if sets[z] is None:
                        sets[z] = set(rows[z][4].tolist())
                similar, certain = enough(len(sets[x] & sets[y]), n, other[3])
                if similar and (not certain or joined.add(comp, other[1])):
                    yield (key, other[0]) if key < other[0] else (other[0], key)

    def many(rows: list[tuple], value: int, cut: bool) -> Iterator[tuple[bytes, bytes]]:
        size = [len(r[4]) for r in rows]
        owner = np.repeat(np.arange(len(rows), dtype=np.int32), size)
        _, column, often = np.unique(np.concatenate([r[4] for r in rows]), return_inverse=True, return_counts=True)
        shared_by_some = often[column] > 1
        column = (np.cumsum(often > 1) - 1).astype(np.int32)[column[shared_by_some]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[shared_by_some][order], column[order]
        n = np.array([r[3] for r in rows], dtype=np.float32)
        _, comp = np.unique(np.array([r[1].hex() for r in rows]), return_inverse=True)
        side = np.array([r[2] for r in rows])
        joined = Joined()
        part = np.zeros((len(rows), _COLUMNS), dtype=np.float32)
        for first in range(0, len(rows), _ROWS):
            last = min(first + _ROWS, len(rows))
            shared = np.zeros((last - first, len(rows)), dtype=np.float32)
            for low in range(0, int((often > 1).sum()), _COLUMNS):
                here = slice(*np.searchsorted(column, [low, low + _COLUMNS]))
                part[owner[here], column[here] - low] = 1
                shared += part[first:last] @ part.T
                part[owner[here], column[here] - low] = 0
            ok, whole = enough(shared, n[first:last, None], n[None, :])
            ok &= comp[first:last, None] != comp[None, :]
            if cut:
                ok &= side[first:last, None] != side[None, :]
            for x in range(last - first):
                a = rows[first + x]
                for y in np.flatnonzero(ok[x]):
                    b = rows[y]
                    if a[0] < b[0] and first_met(a[5], b[5]) == value and (not whole[x, y] or joined.add(a[1], b[1])):
                        yield a[0], b[0]

    def first_met(x: frozenset, y: frozenset) -> int:
        """Of all lists in which two documents meet, one compares them."""
        return min(x & y)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
        held: list[tuple] = []
        now = None
        for batch in batches:
            value, i, j, side, n = (batch.column(c).to_pylist() for c in range(5))
            key, comp, least, listed = batch.column(5).to_pylist(), batch.column(6).to_pylist(), batch.column(7), batch.column(8)
            for r in range(batch.num_rows):
                group = (value[r], i[r], j[r])
                if group != now:
                    yield now, held
                    held, now = [], group
                held.append((key[r], comp[r], side[r], n[r], least[r].values.to_numpy(), frozenset(listed[r].values.to_pylist())))
        yield now, held

    def similar(group: tuple | None, held: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        if len(held) < 2:
            return iter(())
        cut = group[1] != group[2]
        return few(held, group[0]) if len(held) <= _FEW and not cut else many(held, group[0], cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (pair for group, held in groups(batches) for pair in similar(group, held))
        while out := list(islice(pairs, _PAIRS)):
            yield pairs_of(out)

    def pairs_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[x] for p in out], pa.binary()) for x in (0, 1)], ["a", "b"])

    return run


def _across(lists: DataFrame, member: DataFrame, sets: DataFrame, percent: int, chunk: int) -> DataFrame:
    """Candidate pairs of lists that hold more than one component."""
    rows = lists.join(member, "key", "left").select("value", "key", F.coalesce("component", "key").alias("component"))
    mixed = rows.groupBy("value").agg(F.count("*").alias("m"), F.min("component").alias("x"), F.max("component").alias("y"))
    mixed = mixed.where("x != y").select("value", F.when(F.col("m") > chunk, F.ceil(2 * F.col("m") / chunk)).otherwise(1).alias("blocks"))
    rows = rows.join(mixed, "value").withColumn("side", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    listed = rows.groupBy("key").agg(F.collect_set("value").alias("listed"))  # at most as many as a sketch lists
    listed = materialize(listed, "listed")
    some = _needed(sets.select("key", "n", F.slice("least", 1, SKETCH).alias("least")), listed.select("key"))
    least = some.join(listed, "key")
    dealt = rows.withColumn("other", other).join(least, "key").select(
        "value", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "n", "key", "component",
        "least", "listed",
    )
    dealt = dealt.repartition("value", "i", "j").sortWithinPartitions("value", "i", "j")
    return dealt.mapInArrow(_compare(percent), "a binary, b binary").distinct()


def similar_components(texts: DataFrame, sets: DataFrame, percent: int = PERCENT, chunk: int = CHUNK) -> DataFrame:
    """``node, component`` for keys with a link; ``texts``: key, text; ``sets``: key, n, least, one row for a key."""
    lists = materialize(_listed(sets.where("n > 0"), percent), "listed")
    discard(sets)
    centre = F.max_by("key", F.struct("weight", "key")).alias("a")
    centres = lists.groupBy("value").agg(centre, F.count("*").alias("m")).where("m > 1").select("value", "a")
    met = materialize(lists.join(centres, "value").select("value", "key", "a"), "lists")
    discard(lists)
    keys = met.select("key").distinct()
    full = texts.join(keys, "key", "left_semi").dropDuplicates(["key"]).select("key", "text")
    full = materialize(full.mapInArrow(_sets(None), "key binary, n int, least array<bigint>"), "sets")
    stars = met.where("a != key").select(F.least("a", "key").alias("a"), F.greatest("a", "key").alias("b")).distinct()
    links = materialize(_verified(stars, full, percent), "links")
    member = materialize(connected_components(links), "components").select(F.col("node").alias("key"), "component")
    more = _across(met.select("value", "key"), member, full, percent, chunk)
    pairs = materialize(more, "pairs")
    found = materialize(_verified(pairs, full, percent), "links")
    out = materialize(connected_components(links.union(found)), "components")
    discard(met, full, links, pairs, found)
    return out


def judge(docs: DataFrame, percent: int = PERCENT, chunk: int = CHUNK) -> DataFrame:
    """Per document: the size of its set, its component, and whether it is the one that stays."""
    rows, component = _components(docs.select("doc_id", "text"), percent, chunk)
    return rows.join(component, "root").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", _stays().alias("kept"))


def _stays() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("component_id"))


def _components(docs: DataFrame, percent: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``key, root, n``, and the ``component_id`` of each root."""
    prepare(docs.sparkSession)
    keyed = docs.select(_key(F.col("text")).alias("key"), "doc_id", "text")
    schema = T.StructType(keyed.select("key", "doc_id").schema.fields + T.StructType.fromDDL("n int, least array<bigint>").fields)
    every = materialize(keyed.mapInArrow(_sets(LISTED), schema), "sketches")
    rows = materialize(every.select("key", "doc_id", "n"), "keys")
    sets = materialize(every.dropDuplicates(["key"]).select("key", "n", "least"), "sketches")
    discard(every)
    member = similar_components(keyed.select("key", "text"), sets, percent, chunk)
    # Texts without words are equal but not linked: each row is its own root, told apart by its id.
    root = F.coalesce("component", F.when(F.col("n") > 0, F.col("key")))
    rows = rows.join(member.select(F.col("node").alias("key"), "component"), "key", "left")
    alone = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")
    rows = rows.select("key", "doc_id", "n", F.coalesce(root, F.concat(F.lit(b"-"), alone)).alias("root"))
    return rows, rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))


def keep_first(docs: DataFrame, percent: int = PERCENT, chunk: int = CHUNK) -> DataFrame:
    """The rows of each component that carry its smallest doc_id, with all their columns."""
    rows, component = _components(docs.select("doc_id", "text"), percent, chunk)
    gone = rows.join(component, "root").where(~_stays()).select(F.col("doc_id").alias("of"), F.col("key").alias("of_key")).distinct()
    whole = packed(docs, "doc_id", _key(F.col("text")).alias("key"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    return unpacked(whole.join(gone, same, "left_anti"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
