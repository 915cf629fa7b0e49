"""Removal of every byte inside a string of 200 bytes that also starts somewhere else, by a distributed merge sort.

Only suffixes that can matter are sorted. In any ``length`` bytes the least of the hashes of its first ``SPAN`` grams of
``GRAM`` bytes marks an anchor; equal strings have their anchors at equal places, so two equal strings are found at two
equal grams, one on each anchor, and the sort needs the suffixes at anchors alone, some 1.5 in a hundred.

1. Anchors: each text gives its anchors with the range of string starts that belong to each. Grams that occur once in
   the corpus cannot match and drop out.
2. Runs: each task sorts the suffixes at its anchors (hash of the gram first, so that ranges are even without sampling),
   joins equal ones, and front-codes them: the length of the prefix shared with the suffix before, and the rest.
3. Exchange: the range of the hash decides where a piece of a run goes.
4. Merge: a loser tree takes the pieces together. It holds for each head the prefix it shares with the last winner and
   compares behind that only; shared prefixes are never compared again.
5. Strings reach to the left of their anchor too, so suffixes of one gram are compared on both sides, pair by pair or,
   for many, by hashes of all their strings.

A gram with more than ``HOT`` anchors (a text of which there are very many copies or variants) would be too much for one
task. Anchors with equal surroundings, those of copies, are counted first, by the gram's hash and another one of all that
their strings cover: all these strings repeat, and one of them goes on for all. What is still too much is split by how far strings reach to the left, each class being keyed by all the
bytes that its strings share, again and again if need be; in the end a class is one string, and its count alone decides.

Defined results: strings are UTF-8 bytes, within one row; a null text is empty; texts shorter than a string are left
whole. Rows that repeat a document count as occurrences of each other: all their strings repeat, and the text is looked
at once, however many rows there are. Rows are told apart by id and text, equal ones are treated alike. Cutting inside a character drops the rest of it from the text of ``clean``, never from the digest of
``judge``. Extra columns stay with their rows in ``clean``. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.llm.common import packed, prepare, table
from sparkwarden.session import discard, materialize

LENGTH, GRAM = 200, 64
SPAN = LENGTH - GRAM + 1
# Starts of strings that are looked at together.
BLOCK = 1 << 18
# Anchors of one gram that one task takes.
HOT = 32_768
# Places and bytes that are worked on at once.
STEP, BYTES = 1 << 13, 1 << 17
# Suffixes of one run in memory, and of one range in a merge, roughly.
RUN, RANGE = 60_000, 30_000
PAIRS = 16

_BASE = np.uint64(0x9E3779B97F4A7C15)
_ROW = "id long, hash long, lo int, a int, hi int"


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for factor in (_BASE, inverse):
        row = np.full(n, factor, dtype=np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


@cache
def _bytes_hashed() -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Hashes:
    """Hashes of any part of some bytes, from sums over all prefixes."""

    def __init__(self, data: np.ndarray) -> None:
        size = 1 << max(16, int(len(data)).bit_length())
        self.up, self.down = _powers(size)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_bytes_hashed()[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


def anchors(data: np.ndarray, around: bool = False) -> tuple[np.ndarray, ...]:
    """Gram hash, first start, anchor and last start, for each anchor of a text.

    ``around`` adds a hash of all the bytes that an anchor's strings cover, and of the anchor's place in them.
    """
    parts = []
    for at in range(0, max(len(data) - LENGTH + 1, 0), BLOCK):
        part = data[at : at + BLOCK + LENGTH - 1]
        n = len(part) - LENGTH + 1
        h = Hashes(part)
        grams = h.grams(GRAM)
        least, step = grams, 1
        while 2 * step <= SPAN:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        least = np.minimum(least[:n], least[SPAN - step : SPAN - step + n])
        # The least gram changes, or its first place has been left behind.
        lo = np.concatenate([[0], np.flatnonzero((least[1:] != least[:-1]) | (grams[: n - 1] == least[:-1])) + 1])
        seen = sliding_window_view(grams, SPAN)
        a = lo + np.concatenate([np.argmin(seen[lo[i : i + STEP]], axis=1) for i in range(0, len(lo), STEP)])
        hi = np.append(lo[1:] - 1, n - 1)
        # Least hashes are small; mixed once more, they are spread evenly over all ranges.
        parts.append((_mixed(grams[a] + _BASE), lo + at, a + at, hi + at))
        if around:
            covered = h.of(lo, hi + LENGTH) + (a - lo).astype(np.uint64) * _BASE + (hi - lo).astype(np.uint64)
            parts[-1] = (*parts[-1], _mixed(covered))
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none, *[none.astype(np.uint64)] * around
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _utf8(column: pa.Array, i: int) -> np.ndarray:
    value = column[i]
    return np.frombuffer(value.as_buffer(), dtype=np.uint8) if value.is_valid else np.zeros(0, dtype=np.uint8)


_ANCHOR = pa.schema([("h", pa.int64()), ("id", pa.int64()), ("hash", pa.int64()), ("lo", pa.int32()), ("a", pa.int32()), ("hi", pa.int32())])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, hashes, texts = (batch.column(i) for i in range(3))
        found, rows = [], []
        for i in range(batch.num_rows):
            one = anchors(_utf8(texts, i), around=True)
            if len(one[0]):
                found.append(one)
                rows.append((i, len(one[0])))
        if found:
            made = _anchor_rows(ids, hashes, rows, [one[:4] for one in found])
            around = pa.array(np.concatenate([one[4] for one in found]).view(np.int64))
            yield pa.RecordBatch.from_arrays([*made.columns, around], [*made.schema.names, "c"])


def _anchor_rows(ids, hashes, rows, found) -> pa.RecordBatch:
    index = pa.array(np.repeat([i for i, _ in rows], [n for _, n in rows]))
    h, lo, a, hi = (np.concatenate(x) for x in zip(*found, strict=True))
    arrays = [pa.array(h.view(np.int64)), ids.take(index), hashes.take(index), *(pa.array(x.astype(np.int32)) for x in (lo, a, hi))]
    return pa.RecordBatch.from_arrays(arrays, schema=_ANCHOR)


def _refiner(width: int):
    """Anchors of texts, split by how far their strings reach to the left, in classes of ``width``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, texts, spots = (batch.column(i) for i in range(4))
            found, rows = [], []
            for i in range(batch.num_rows):
                h = Hashes(_utf8(texts, i))
                lo, a, hi = _spots(spots[i])[1:]
                first, last = (a - hi) // width, (a - lo) // width
                count = last - first + 1
                near = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                low, high = near * width, np.minimum((near + 1) * width, SPAN) - 1
                lo, a, hi = (np.repeat(x, count) for x in (lo, a, hi))
                key = h.of(a - low, a + LENGTH - high) + near.astype(np.uint64)
                found.append((key, np.maximum(lo, a - high), a, np.minimum(hi, a - low)))
                rows.append((i, len(key)))
            if found:
                yield _anchor_rows(ids, hashes, rows, found)

    return run


def _spots(value) -> tuple[np.ndarray, ...]:
    items = value.values
    return tuple(items.field(i).to_numpy(zero_copy_only=False).astype(t) for i, t in enumerate((np.int64,) * 4))


def _front_coded(records: dict, ranges: int) -> Iterator[tuple[int, bytes]]:
    """One run, cut by range: shared prefix lengths, rests, left parts and owners of its distinct suffixes, in order."""
    order = sorted(records)
    at = 0
    while at < len(order):
        part = int.from_bytes(order[at][0][:8], "big") * ranges >> 64
        shared, rests, lefts, owners = [], [], [], []
        before = b""
        while at < len(order) and int.from_bytes(order[at][0][:8], "big") * ranges >> 64 == part:
            key = order[at]
            n = common(before, key[0], 0)
            shared.append(n)
            rests.append(key[0][n:])
            lefts.append(key[1])
            owners.append(records[key])
            before = key[0]
            at += 1
        yield part, pa.compress(pickle.dumps((shared, rests, lefts, owners), 5), codec="zstd", asbytes=True)


def common(x: bytes, y: bytes, at: int) -> int:
    """Length of the common prefix of two texts that share the first ``at`` bytes."""
    n = min(len(x), len(y))
    x, y = x[at:n], y[at:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (differ.bit_length() + 7) // 8


def common_end(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    if not n:
        return 0
    x, y = x[-n:], y[-n:]
    if x == y:
        return n
    differ = int.from_bytes(x, "little") ^ int.from_bytes(y, "little")
    return n - (differ.bit_length() + 7) // 8


def _runs(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        n = 0
        for batch in batches:
            ids, hashes, texts, spots = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                text = texts[i].as_buffer().to_pybytes()
                owner = (ids[i].as_py(), hashes[i].as_py())
                h, lo, a, hi = _spots(spots[i])
                keys = h.view(np.uint64).astype(">u8").tobytes()
                for j, (first, at, last) in enumerate(zip(lo.tolist(), a.tolist(), hi.tolist(), strict=True)):
                    key = (keys[8 * j : 8 * j + 8] + text[at : last + LENGTH], text[first:at])
                    held.setdefault(key, []).append((owner, at))
                    n += 1
                if n >= RUN:
                    yield _pieces(held, ranges)
                    held, n = {}, 0
        if held:
            yield _pieces(held, ranges)

    return run


def _pieces(held: dict, ranges: int) -> pa.RecordBatch:
    rows = list(_front_coded(held, ranges))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["range", "run"])


def merge(runs: list[tuple[list, list, list, list]]) -> Iterator[tuple[int, bytes, bytes, list]]:
    """All suffixes of front-coded runs in order: prefix shared with the one before, suffix, left part, owners.

    A loser tree. ``share[i]`` is what the head of run i shares with the last winner. The head that shares more is the
    smaller one, and what the loser shares with it is the loser's number; only at equal numbers are bytes compared,
    from there on. A run's own front code gives the number of its next head.
    """
    k = len(runs)
    at = [0] * k
    head: list[bytes | None] = [r[1][0] for r in runs]
    share = [0] * k

    def beats(i: int, j: int) -> bool:
        """Whether head i goes before head j; the loser then knows what it shares with the winner."""
        x, y = head[i], head[j]
        if x is None or y is None:
            return y is None
        if share[i] != share[j]:
            return share[i] > share[j]
        n = common(x, y, share[i])
        first = x[n : n + 1] < y[n : n + 1] or (n == len(x) == len(y) and i < j)
        share[j if first else i] = n
        return first

    loser = [-1] * k
    winner = -1
    for i in range(k):
        # A head goes up until it meets an empty place, and waits there.
        now, node = i, (i + k) // 2
        while node:
            if loser[node] < 0:
                loser[node], now = now, -1
                break
            if beats(loser[node], now):
                loser[node], now = now, loser[node]
            node //= 2
        if now >= 0:
            winner = now
    while head[winner] is not None:
        shared, rests, lefts, owners = runs[winner]
        p = at[winner]
        text = head[winner]
        yield share[winner], text, lefts[p], owners[p]
        at[winner] = p = p + 1
        if p < len(rests):
            head[winner] = text[: shared[p]] + rests[p]
            share[winner] = shared[p]
        else:
            head[winner] = None
        now, node = winner, (winner + k) // 2
        while node:
            if beats(loser[node], now):
                loser[node], now = now, loser[node]
            node //= 2
        winner = now


_SPAN = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])


def _merged(data: pa.Table) -> pa.Table:
    runs = [_run(x) for x in data.column("run")]
    out: list[tuple] = []
    group: dict = {}
    shares: list[int] = []
    low = 1 << 30
    for shared, text, left, owners in merge(runs):
        if shared < 8:
            resolve(group, shares, out)
            group, shares, low = {}, [], 1 << 30
        low = min(low, shared - 8)
        key = (text[8:], left)
        if key in group:
            group[key] = group[key] + owners
        else:
            group[key] = owners
            shares.append(low)
            low = 1 << 30
    resolve(group, shares, out)
    columns = list(zip(*out, strict=True)) or [[], [], [], []]
    return pa.table([pa.array(c, type=f.type) for c, f in zip(columns, _SPAN, strict=True)], schema=_SPAN)


def _run(value: pa.Scalar) -> tuple:
    stream = pa.CompressedInputStream(pa.BufferReader(value.as_buffer()), "zstd")
    return pickle.loads(stream.read())


def resolve(group: dict, shares: list[int], out: list[tuple]) -> None:
    """The starts of strings that occur twice among the suffixes of one gram, with their owners.

    ``group``: (suffix, what is left of it) to owners, in order of the suffixes; ``shares``: prefix shared with the one
    before. A string that starts o bytes left of the anchor needs o equal bytes there and ``LENGTH - o`` from it on.
    """
    items = list(group.items())
    if len(items) == 1 and len(items[0][1]) == 1:
        return
    found: list[list[tuple[int, int]]] = [[] for _ in items]
    if len(items) > PAIRS:
        _by_strings([left + right for (right, left), _ in items], [len(left) for (_, left), _ in items], found)
    else:
        for i, ((right, left), _) in enumerate(items):
            low = len(right)
            for j in range(i + 1, len(items)):
                low = min(low, shares[j])
                far = common_end(left, items[j][0][1])
                if LENGTH - low <= far:
                    found[i].append((LENGTH - low, far))
                    found[j].append((LENGTH - low, far))
    for ((right, left), owners), near in zip(items, found, strict=True):
        whole = (LENGTH - len(right), len(left))
        for low, high in [whole] if len(owners) > 1 else set(near):
            low, high = max(low, whole[0]), min(high, whole[1])
            if low <= high:
                out += [(*owner, a - high, a - low) for owner, a in owners]


def _by_strings(texts: list[bytes], lefts: list[int], found: list[list[tuple[int, int]]]) -> None:
    size = np.array([len(t) for t in texts])
    number = size - LENGTH + 1
    owner = np.repeat(np.arange(len(texts)), number)
    place = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    strings = []
    at = 0
    while at < len(texts):
        end = at + max(int(np.searchsorted(np.cumsum(size[at:]), BYTES, side="right")), 1)
        begin = np.cumsum(size[at:end]) - size[at:end]
        here = (owner >= at) & (owner < end)
        h = Hashes(np.frombuffer(b"".join(texts[at:end]), dtype=np.uint8)).grams(LENGTH)
        strings.append(h[begin[owner[here] - at] + place[here]])
        at = end
    _, inverse, count = np.unique(np.concatenate(strings), return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (twice * (owner + 1)), [0]])))
    for i in edge:
        if i < len(twice) and twice[i]:
            end = i
            while end + 1 < len(twice) and twice[end + 1] and owner[end + 1] == owner[i]:
                end += 1
            left = lefts[owner[i]]
            found[owner[i]].append((int(left - place[end]), int(left - place[i])))


def _candidates(docs: DataFrame, hot: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Anchors whose gram occurs twice or more, ``h`` and ``_ROW``; starts that are decided by counting alone; and the
    tables that both still read."""
    schema = f"h long, {_ROW}"
    rows = materialize(docs.mapInArrow(_find, f"{schema}, c long"), "anchors")
    cold, width, held = [], SPAN, []
    done = docs.sparkSession.createDataFrame([], "id long, hash long, lo int, hi int")
    while True:
        counts = materialize(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "grams")
        if width == 1:
            done = done.unionByName(rows.join(counts, "h").select("id", "hash", "lo", "hi"))
            held += [rows, counts]
            break
        both = materialize(rows.join(counts, "h"), "candidates")
        discard(rows, counts)
        held.append(both)
        cold.append(both.where(F.col("n") <= hot).drop("n", "c"))
        warm = both.where(F.col("n") > hot).drop("n")
        if warm.isEmpty():
            break
        if width == SPAN:
            one = F.min(F.struct("id", "hash", "lo", "a", "hi")).alias("one")
            kinds = materialize(warm.groupBy("h", "c").agg(F.count("*").alias("n"), one), "kinds")
            copies = kinds.where("n > 1").select("h", "c")
            done = done.unionByName(warm.join(copies, ["h", "c"]).select("id", "hash", "lo", "hi"))
            # One of each kind goes on: what a kind of copies shares with others makes those repeat.
            left = kinds.select("h", "one.*")
            sizes = materialize(left.groupBy("h").agg(F.count("*").alias("n")), "grams")
            held += [kinds, sizes]
            cold.append(left.join(sizes.where(F.col("n").between(2, hot)).select("h"), "h"))
            warm = left.join(sizes.where(F.col("n") > hot).select("h"), "h")
            if warm.isEmpty():
                break
        width = (width + 3) // 4
        rows = materialize(_with_texts(docs, warm).mapInArrow(_refiner(width), schema), "anchors")
    found = cold[0]
    for more in cold[1:]:
        found = found.unionByName(more)
    return found, done, held


def _with_texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` (id, hash, text) that have anchors, each text once, with ``spots``: their anchors."""
    spots = rows.groupBy("id", "hash").agg(F.collect_list(F.struct("h", "lo", "a", "hi")).alias("spots"))
    spots = spots.select(F.col("id").alias("__id"), F.col("hash").alias("__hash"), "spots")
    return docs.join(spots, F.col("id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__hash"))).select("id", "hash", "text", "spots")


def _once(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Each text of an id once, and the ones that were there several times: all their strings repeat.

    Texts move for that only if there are such rows.
    """
    times = docs.groupBy("id", "hash").agg(F.count("*").alias("times")).where("times > 1").select("id", "hash")
    times = materialize(times, "repeated")
    if times.isEmpty():
        discard(times)
        return docs, None
    once = docs.groupBy("id", "hash").agg(F.min("text").alias("text")).select("id", "hash", "text")
    of = times.select(F.col("id").alias("__id"), F.col("hash").alias("__hash"))
    same = F.col("id").eqNullSafe(F.col("__id")) & F.col("hash").eqNullSafe(F.col("__hash"))
    last = (F.octet_length("text") - LENGTH).cast("int")
    whole = once.join(of, same, "left_semi").where(last >= 0).select("id", "hash", F.lit(0).alias("lo"), last.alias("hi"))
    return once, whole


def repeated_starts(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``id, hash, spans``: ranges of starts of strings that occur elsewhere too, for ``docs`` (id, hash, text)."""
    spark = docs.sparkSession
    docs, whole = _once(docs)
    found, done, held = _candidates(docs, hot)
    found = materialize(found, "found")
    ranges = max(found.count() // RANGE, spark.sparkContext.defaultParallelism) + 1
    runs = _with_texts(docs, found).mapInArrow(_runs(ranges), "range long, run binary")
    spans = runs.groupBy("range").applyInArrow(_merged, "id long, hash long, lo int, hi int").unionByName(done)
    if whole is not None:
        spans = spans.unionByName(whole)
    spans = spans.distinct().groupBy("id", "hash").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))
    out = materialize(spans, "spans")
    discard(found, *held)
    return out


def removed(n: int, spans: list) -> list[tuple[int, int]]:
    """Maximal runs of bytes that sorted ranges of starts cover."""
    runs: list[tuple[int, int]] = []
    for lo, hi in spans:
        end = min(hi + LENGTH, n)
        if runs and lo <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], end))
        else:
            runs.append((lo, end))
    return runs


def _kept(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for lo, hi in runs:
        parts.append(text[at:lo])
        at = hi
    return b"".join([*parts, text[at:]])


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, spans = (batch.column(i) for i in range(3))
        out = []
        for i in range(batch.num_rows):
            text = texts[i].as_buffer().to_pybytes() if texts[i].is_valid else b""
            runs = removed(len(text), _pairs(spans[i]))
            out.append((ids[i].as_py(), len(text), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_kept(text, runs)).hexdigest()))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _DIGEST, strict=True)], schema=_DIGEST)


def _pairs(value) -> list[tuple[int, int]]:
    if not value.is_valid:
        return []
    lo, hi = (value.values.field(i).to_pylist() for i in range(2))
    return list(zip(lo, hi, strict=True))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, texts, spans = (batch.column(i) for i in range(3))
        out = []
        for i in range(batch.num_rows):
            if not spans[i].is_valid:
                out.append(texts[i].as_py())
                continue
            text = texts[i].as_buffer().to_pybytes()
            out.append(_kept(text, removed(len(text), _pairs(spans[i]))).decode("utf-8", "ignore"))
        yield pa.RecordBatch.from_arrays([row, pa.array(out, pa.string())], ["__row", "__kept"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), "text")


def _joined(rows: DataFrame, spans: DataFrame) -> DataFrame:
    of = spans.select(F.col("id").alias("__id"), F.col("hash").alias("__hash"), "spans")
    return rows.join(of, F.col("id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__hash")), "left")


def judge(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Per document: its bytes, removed bytes, maximal removed runs, and the digest of what is left."""
    prepare(docs.sparkSession)
    rows = _keyed(docs)
    both = _joined(rows, repeated_starts(rows, hot)).select("id", "text", "spans")
    return both.mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def clean(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``docs`` without the repeated bytes; all other columns as they are."""
    prepare(docs.sparkSession)
    rows = packed(docs, F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), "text")
    both = _joined(rows, repeated_starts(_keyed(docs), hot)).select("__row", "text", "spans")
    schema = both.select("__row").schema.add("__kept", "string")
    out = both.mapInArrow(_texts, schema)
    return out.select(*(F.col("__kept").alias(c) if c == "text" else F.col(f"__row.`{c}`") for c in docs.columns))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
