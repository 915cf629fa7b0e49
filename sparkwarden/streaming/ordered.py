"""Steps on a stream that need order: numbered sessions, and timelines without holes.

Sessions get the running number, and so the ids, of the batch job.

The number of a session counts all sessions before it, so each (source, tool) keeps a small state: the number, the
session that is open, and one record for each stretch of ``gap`` seconds that the watermark has not passed. Events of a
stretch always share a session (see ``operators.sessionize``), so a source with very many events holds few records. A
timer on event time looks at a key again when a stretch is complete or its session can grow no more: complete stretches
join the open session or close it and open the next one. A key has one timer, for the next of these times, and its
stretches are read and written together, so that a batch costs a few calls for each key and not for each stretch.

Calls to the state store take far longer than the work on a key's rows, so the keys are dealt by hash to ``BUCKETS``
buckets, and a bucket's keys share one state, two compressed tables, under one timer: a batch costs a few calls for each
bucket, however many keys there are. A batch rewrites the tables of the buckets that it touches, also what they hold of
other keys; for small batches over very many keys, ``buckets=0`` gives each key a state of its own. Both find the same.

State lives in Spark's state store; lateness is the watermark's: rows behind it are left out and counted by
``live.rows_too_late``. Without rows, or before the watermark passes a session's end and the gap, nothing comes out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING, Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sparkwarden.operators.sessionize import SessionConfig, _finish, with_session_id
from sparkwarden.plans.analytics import LABELS
from sparkwarden.schemas import INDICATOR_COLUMNS

if TYPE_CHECKING:
    import pandas as pd

COUNTS = ["event_count", "indicator_hits", *INDICATOR_COLUMNS]
_COUNTED = ", ".join(f"{c} bigint" for c in COUNTS)
# Times in microseconds; ports as a list of different numbers.
RECORD = f"first bigint, last bigint, {_COUNTED}, ports array<bigint>"
OUT = f"src_ip string, tool string, session_idx bigint, start_ts timestamp, end_ts timestamp, {_COUNTED}, unique_ports bigint"
# Fixed value: states hold the bucket's number, so a stream that goes on has to keep it.
BUCKETS = 1024
_HELD_ROWS = 1 << 18  # rows of a bucket that wait to be combined, at most, besides those of one batch
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _typed(columns: str) -> str:
    """Columns as the fields of a struct."""
    return ", ".join(c.replace(" ", ":", 1) for c in columns.split(", "))


def _joined(a: tuple | None, b: tuple) -> tuple:
    """Two records of one session as one."""
    if a is None:
        return b
    counts = [x + y for x, y in zip(a[2:-1], b[2:-1], strict=True)]
    return (min(a[0], b[0]), max(a[1], b[1]), *counts, sorted({*a[-1], *b[-1]}))


class Sessions(StatefulProcessor):
    """Numbered sessions of one (source, tool)."""

    def __init__(self, gap_us: int) -> None:
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stretches = handle.getValueState("stretches", f"wake bigint, held array<struct<slot:bigint, {_typed(RECORD)}>>")
        self.open = handle.getValueState("open", f"number bigint, {RECORD}")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        wake, held = self._held()
        fresh: dict[int, tuple[list, set]] = {}  # per slot: times and counts, ports
        for part in rows:
            for slot, first, last, port, *counts in part[["slot", "first", "last", "src_port", *COUNTS]].itertuples(index=False, name=None):
                at = fresh.get(slot)
                if at is None:
                    at = fresh[slot] = ([first, last, *counts], set())
                else:
                    sums = at[0]
                    sums[:2] = min(sums[0], first), max(sums[1], last)
                    for i, count in enumerate(counts, 2):
                        sums[i] += count
                if port is not None and port == port:
                    at[1].add(int(port))
        for slot, (sums, ports) in fresh.items():
            held[int(slot)] = _joined(held.get(int(slot)), (*map(int, sums), sorted(ports)))
        least = min(held, default=None)
        if least is not None and (wake is None or least + self.gap_us < wake):
            wake = self._wake(least + self.gap_us)
        self._hold(wake, held)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        import pandas as pd

        passed = timerValues.getCurrentWatermarkInMs() * 1000
        _, held = self._held()
        waiting = sorted(held.items())
        state = self.open.get() if self.open.exists() else None
        number, now = (int(state[0]), _plain(state[1:])) if state is not None else (0, None)
        done = []
        taken = 0
        for slot, record in waiting:
            if slot + self.gap_us > passed:
                break
            if now is None or record[0] - now[1] > self.gap_us:
                if now is not None and now[2]:
                    done.append((number, now))
                number, now = number + 1, record
            else:
                now = _joined(now, record)
            taken += 1
        rest = waiting[taken:]
        # The open session ends if neither a waiting stretch nor a row to come can be within its gap. Its last time
        # stays, without counts, so that the next one takes the next number.
        if now is not None and now[2] and passed > now[1] + self.gap_us and not (rest and rest[0][1][0] - now[1] <= self.gap_us):
            done.append((number, now))
            now = (now[0], now[1], *[0] * len(COUNTS), [])
        if now is not None:
            self.open.update((number, *now))
        times = [rest[0][0] + self.gap_us] if rest else []
        if now is not None and now[2] and now[1] + self.gap_us + 1000 > passed:
            times.append(now[1] + self.gap_us + 1000)
        self._hold(self._wake(min(times)) if times else None, dict(rest))
        if done:
            yield pd.DataFrame([self._row(key, n, record) for n, record in done])

    def _held(self) -> tuple[int | None, dict[int, tuple]]:
        """When the key is looked at next, and its stretches."""
        state = self.stretches.get() if self.stretches.exists() else None
        if state is None:
            return None, {}
        return (None if state[0] is None else int(state[0])), {int(r[0]): _plain(r[1:]) for r in state[1]}

    def _hold(self, wake: int | None, held: dict[int, tuple]) -> None:
        if wake is None and not held:
            self.stretches.clear()
        else:
            self.stretches.update((wake, [(slot, *record) for slot, record in sorted(held.items())]))

    def _wake(self, at_us: int) -> int:
        self.handle.registerTimer(-(-at_us // 1000))
        return at_us

    def _row(self, key: Any, number: int, record: tuple) -> dict:
        import pandas as pd

        out = {"src_ip": key[0], "tool": key[1], "session_idx": number}
        out |= {"start_ts": pd.Timestamp(record[0], unit="us"), "end_ts": pd.Timestamp(record[1], unit="us")}
        return out | dict(zip(COUNTS, record[2:-1], strict=True)) | {"unique_ports": len(record[-1])}

    def close(self) -> None:
        pass


class Buckets(StatefulProcessor):
    """The same sessions, with one state for all (source, tool) of a bucket.

    Rows of both tables are combined by session or stretch and port. ``waiting`` has those of stretches that the watermark
    has not passed, ``sessions`` those of the last session of each key; when that one has ended, a row without counts
    keeps its number and last time.
    """

    def __init__(self, gap_us: int) -> None:
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "wake bigint, rows binary")
        self.sessions = handle.getValueState("sessions", "rows binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        wake, held = self._held()
        fresh, waiting = [held], 0
        for part in rows:
            fresh.append(_stretch_rows(part, self.gap_us))
            waiting += len(part)
            if waiting > _HELD_ROWS:
                fresh, waiting = [_combined(fresh, "place")], 0
        held = _combined(fresh, "place")
        least = pc.min(held["place"]).as_py()
        if least is not None and (wake is None or least + self.gap_us < wake):
            wake = self._wake(least + self.gap_us)
        self._hold(wake, held)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        wake, held = self._held()
        if wake is None or wake > passed:  # a timer that an earlier one has replaced
            return
        known = self.sessions.get() if self.sessions.exists() else None
        known = _EMPTY if known is None else _unpacked(known[0])
        done, known, held, wake = _advanced(known, held, self.gap_us, passed)
        self.sessions.update((_packed(known),))
        self._hold(None if wake is None else self._wake(wake), held)
        if len(done):
            yield done

    def _held(self) -> tuple[int | None, pa.Table]:
        """When the bucket is looked at next, and its waiting rows."""
        state = self.waiting.get() if self.waiting.exists() else None
        return (None, _EMPTY) if state is None else (state[0], _unpacked(state[1]))

    def _hold(self, wake: int | None, held: pa.Table) -> None:
        if wake is None and not held.num_rows:
            self.waiting.clear()
        else:
            self.waiting.update((wake, _packed(held)))

    def _wake(self, at_us: int) -> int:
        self.handle.registerTimer(-(-at_us // 1000))
        return at_us

    def close(self) -> None:
        pass


# ``place``: start of the stretch, or number of the session.
_KEYS = ["src_ip", "tool", "place", "port"]
_ROWS = pa.schema([("src_ip", pa.string()), ("tool", pa.string()), *[(c, pa.int64()) for c in ("place", "port", "first", "last", *COUNTS)]])
_EMPTY = _ROWS.empty_table()
_LONG_AGO = -(1 << 62)
_SUMS = [("first", "min"), ("last", "max"), *[(c, "sum") for c in COUNTS]]


def _packed(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, _ROWS, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(rows)
    return out.getvalue().to_pybytes()


def _unpacked(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(rows)).read_all()


def _combined(parts: list[pa.Table], place: str) -> pa.Table:
    """One row for each key, place and port."""
    found = pa.concat_tables(parts).group_by([*_KEYS[:2], place, "port"], use_threads=False).aggregate(_SUMS)
    names = {f"{c}_{how}": c for c, how in _SUMS}
    return found.rename_columns([names.get(c, c) for c in found.column_names]).select(_ROWS.names).cast(_ROWS)


def _stretch_rows(events: pd.DataFrame, gap_us: int) -> pa.Table:
    """Events as rows by stretch and port; ``has_port`` is 0 where the port is null."""
    at = events["at"].to_numpy(np.int64)
    port = events["src_port"].to_numpy(np.int64)
    columns = [pa.array(events[c], pa.string(), from_pandas=True) for c in _KEYS[:2]]
    columns += [pa.array(at - at % gap_us), pa.array(port, mask=events["has_port"].to_numpy() == 0), pa.array(at), pa.array(at)]
    columns += [pa.array(np.ones(len(at), np.int64)), *[pa.array(events[c].to_numpy(np.int64)) for c in COUNTS[1:]]]
    return _combined([pa.table(columns, schema=_ROWS)], "place")


def _codes(*columns: pa.ChunkedArray) -> np.ndarray:
    """A number for each different row of the columns; null is a value like any other."""
    code = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        one = column.combine_chunks().dictionary_encode(null_encoding="encode")
        code = code * max(len(one.dictionary), 1) + one.indices.to_numpy(zero_copy_only=False)
    return np.unique(code, return_inverse=True)[1]


def _numbers(rows: pa.Table, name: str) -> np.ndarray:
    return rows[name].to_numpy()


def _advanced(known: pa.Table, held: pa.Table, gap_us: int, passed: int) -> tuple[pd.DataFrame, pa.Table, pa.Table, int | None]:
    """Sessions that have ended by ``passed``, the last session of each key, what waits on, and when to look again."""
    import pandas as pd

    due = _numbers(held, "place") + gap_us <= passed
    ripe, rest = held.filter(pa.array(due)), held.filter(pa.array(~due))
    code = _codes(*[pa.chunked_array([*known[c].chunks, *ripe[c].chunks, *rest[c].chunks], pa.string()) for c in _KEYS[:2]])
    old, new, later = np.split(code, np.cumsum([known.num_rows, ripe.num_rows]))
    keys = code.max(initial=-1) + 1
    number, last = np.zeros(keys, np.int64), np.full(keys, _LONG_AGO)
    number[old] = _numbers(known, "place")
    np.maximum.at(last, old, _numbers(known, "last"))

    # Stretches in order of key and time; a number grows where one starts too long after the end of the one before.
    order = np.lexsort((_numbers(ripe, "place"), new))
    of, slot = new[order], _numbers(ripe, "place")[order]
    starts = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (slot[1:] != slot[:-1])][: len(of)])
    placed = np.zeros(len(of), np.int64)
    if len(of):
        who = of[starts]
        begin = np.minimum.reduceat(_numbers(ripe, "first")[order], starts)
        end = np.maximum.reduceat(_numbers(ripe, "last")[order], starts)
        same = np.r_[False, who[1:] == who[:-1]]
        before = np.where(same, np.r_[0, end[:-1]], last[who])
        opens = np.cumsum((~same & (number[who] == 0)) | (begin - before > gap_us))
        heads = np.flatnonzero(~same)
        # What opened before a key's first stretch belongs to other keys.
        ahead = np.repeat(np.r_[0, opens[heads[1:] - 1]], np.diff(np.r_[heads, len(who)]))
        placed[order] = np.repeat(number[who] + opens - ahead, np.diff(np.r_[starts, len(of)]))
    ripe = ripe.set_column(_KEYS.index("place"), "place", pa.array(placed))
    rows = _combined([known, ripe], "place")

    # The last session of a key ends if neither a waiting stretch nor a row to come can be within its gap.
    code = _codes(*[pa.chunked_array([*rows[c].chunks, *rest[c].chunks], pa.string()) for c in _KEYS[:2]])
    of, later = np.split(code, [rows.num_rows])
    keys = code.max(initial=-1) + 1
    number, last = np.zeros(keys, np.int64), np.full(keys, _LONG_AGO)
    np.maximum.at(number, of, _numbers(rows, "place"))
    current = _numbers(rows, "place") == number[of]
    np.maximum.at(last, of, _numbers(rows, "last"))
    filled = np.zeros(keys, bool)
    np.logical_or.at(filled, of, current & (_numbers(rows, "event_count") > 0))
    follows = np.full(keys, np.iinfo(np.int64).max)
    np.minimum.at(follows, later, _numbers(rest, "first"))
    goes_on = (follows != np.iinfo(np.int64).max) & (follows - last <= gap_us)
    ends = filled & (passed > last + gap_us) & ~goes_on
    over = rows.filter(pa.array(~current | ends[of]))
    kept = rows.filter(pa.array(current & ~ends[of]))
    ended = rows.filter(pa.array(current & ends[of])).group_by(_KEYS[:3], use_threads=False).aggregate(_SUMS[:2]).to_pydict()
    marks = {"src_ip": ended["src_ip"], "tool": ended["tool"], "place": ended["place"], "first": ended["first_min"], "last": ended["last_max"]}
    n = len(ended["place"])
    marks |= {"port": [None] * n} | {c: [0] * n for c in COUNTS}
    kept = pa.concat_tables([kept, pa.table(marks, schema=_ROWS)])

    times = [int(_numbers(rest, "place").min()) + gap_us] if rest.num_rows else []
    until = last[filled & ~ends] + gap_us + 1000
    times += [int(until[until > passed].min())] if (until > passed).any() else []
    return _ended(over, pd), kept, rest, min(times, default=None)


def _ended(rows: pa.Table, pd: Any) -> pd.DataFrame:
    """A row as in ``OUT`` for each session."""
    found = rows.group_by(_KEYS[:3], use_threads=False).aggregate([*_SUMS, ("port", "count")])
    found = found.filter(pc.greater(found["event_count_sum"], 0)).to_pandas()
    out = {"src_ip": found["src_ip"], "tool": found["tool"], "session_idx": found["place"]}
    out |= {"start_ts": pd.to_datetime(found["first_min"], unit="us"), "end_ts": pd.to_datetime(found["last_max"], unit="us")}
    return pd.DataFrame(out | {c: found[f"{c}_sum"] for c in COUNTS} | {"unique_ports": found["port_count"]})


def _plain(record: Any) -> tuple | None:
    """A stored record with Python's own numbers."""
    return None if record is None else (*(int(x) for x in record[:-1]), [int(p) for p in record[-1]])


def numbered_sessions(events: DataFrame, cfg: SessionConfig = SessionConfig(), buckets: int = BUCKETS) -> DataFrame:
    """Finished sessions of ``live.live_events``, with the ids that the batch job gives them.

    ``buckets``: how many states the keys share; 0 gives each key its own.
    """
    if cfg.gap_us < 1_000_000:
        raise ValueError("a gap of a second at least is needed on streams")
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    micros = F.unix_micros("ts_dt_utc")
    sums = [F.col("indicator_count").cast("bigint").alias("indicator_hits"), *[F.col(c).cast("bigint").alias(c) for c in INDICATOR_COLUMNS]]
    port = F.col("src_port").cast("bigint")
    if buckets:
        bucket = F.pmod(F.xxhash64("src_ip", "tool"), F.lit(buckets)).cast("int").alias("bucket")
        # Without nulls, numbers stay whole numbers in Pandas.
        ports = [F.coalesce(port, F.lit(0)).alias("src_port"), port.isNotNull().cast("bigint").alias("has_port")]
        rows = events.select(bucket, "src_ip", "tool", "ts_dt_utc", micros.alias("at"), *sums, *ports)
        found = rows.groupBy("bucket").transformWithStateInPandas(Buckets(cfg.gap_us), OUT, "Append", "EventTime")
    else:
        rows = events.select(
            "src_ip", "tool", "ts_dt_utc", (micros - F.pmod(micros, F.lit(cfg.gap_us))).alias("slot"), micros.alias("first"),
            micros.alias("last"), F.lit(1).cast("bigint").alias("event_count"), *sums, port.alias("src_port"),
        )
        found = rows.groupBy("src_ip", "tool").transformWithStateInPandas(Sessions(cfg.gap_us), OUT, "Append", "EventTime")
    return _finish(with_session_id(found), cfg)


class Holes(StatefulProcessor):
    """All buckets of a timeline, with zeros in those that no row falls into."""

    def __init__(self, width_s: int, counts: list[str]) -> None:
        self.width_s, self.counts = width_s, counts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "second bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        import pandas as pd

        # A window comes once, when the watermark has passed it, so no later batch brings an earlier one.
        new = pd.concat(list(rows)).set_index("second")[self.counts].sort_index()
        first = int(self.last.get()[0]) + self.width_s if self.last.exists() else int(new.index[0])
        self.last.update((int(new.index[-1]),))
        grid = pd.RangeIndex(first, int(new.index[-1]) + 1, self.width_s)
        whole = new.reindex(grid, fill_value=0)
        for at in range(0, len(whole), 10_000):
            part = whole.iloc[at : at + 10_000]
            yield part.assign(bucket=pd.to_datetime(part.index, unit="s"))[["bucket", *self.counts]].reset_index(drop=True)

    def close(self) -> None:
        pass


def live_timeline(events: DataFrame, minutes: int = 5, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """``bucket`` and a count for each label, for every bucket from the first to the last that has events.

    ``events``: ``ts_dt_utc`` with a watermark, and ``label``; those without a label are not counted. One row for each
    bucket reaches the step that fills the holes, so a single key is enough there.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    known = events.filter(F.col("label").isNotNull())
    sums = [F.count_if(F.col("label") == lab).alias(lab) for lab in labels]
    counted = known.groupBy(F.window("ts_dt_utc", f"{minutes} minutes")).agg(*sums)
    rows = counted.select(F.unix_seconds("window.start").alias("second"), *labels, F.lit(0).alias("all"))
    out = "bucket timestamp, " + ", ".join(f"{lab} bigint" for lab in labels)
    return rows.groupBy("all").transformWithStateInPandas(Holes(60 * minutes, list(labels)), out, "Append", "None")
