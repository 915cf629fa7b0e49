import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkwarden.operators.enrich import enrich_events
from sparkwarden.operators.sessionize import SessionConfig, build_sessions
from sparkwarden.plans import analytics
from sparkwarden.sources.raw_log import parse_lines, read_raw_lines, rejected_lines
from sparkwarden.streaming import live, ordered, sink

START = datetime(2024, 3, 1)


def line(time, ip="1.1.1.1", port="1", agent="curl/8", action="/"):
    return json.dumps([None, action, str(time), ip, port, agent])


def feed(folder, *files):
    """Each list of lines as one more file."""
    folder.mkdir(exist_ok=True)
    there = len(list(folder.iterdir()))
    for i, lines in enumerate(files):
        path = folder / f"{there + i:03d}.log"
        path.write_text("\n".join(lines))
        os.utime(path, (1.7e9 + there + i,) * 2)  # files are read in order of their times


def run(stream, out):
    query = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state")
    query = query.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def batch(spark, folder, cfg):
    found = build_sessions(enrich_events(parse_lines(read_raw_lines(spark, str(folder)))), cfg)
    return sorted(tuple(r) for r in found.where("src_ip != '9.9.9.9'").collect())


@pytest.mark.parametrize("gap", [600, 45])
def test_streamed_sessions_have_the_ids_of_the_batch_job(spark, tmp_path, gap):
    """Files in order, events mixed within a file, a restart between the files, sessions over all file borders."""
    rng = random.Random(gap)
    times = sorted(START + timedelta(seconds=rng.randrange(3 * 3600)) for _ in range(300))
    lines = [line(t, f"10.0.0.{rng.randrange(4)}", str(rng.randrange(5)), rng.choice(["curl/8", None]), rng.choice(["/", "/etc/passwd"])) for t in times]
    lines += [line(START + timedelta(seconds=k // 9), "10.0.0.9") for k in range(200)]  # many in one second
    lines.sort(key=lambda x: json.loads(x)[2])
    parts = [lines[:150], lines[150:151], lines[151:420], lines[420:]]
    for p in parts:
        rng.shuffle(p)
    source, cfg = tmp_path / "in", SessionConfig(gap, 2)
    for files in (parts[:2], parts[2:], [[line(START + timedelta(days=400), "9.9.9.9")]]):
        feed(source, *files)
        run(ordered.numbered_sessions(live.live_events(spark, str(source), files_at_once=1), cfg), tmp_path / "out")
    found = spark.read.parquet(str(tmp_path / "out/rows"))
    assert sorted(tuple(r) for r in found.collect()) == batch(spark, source, cfg)


def test_sessions_wait_for_the_watermark_and_late_rows_are_counted(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    feed(source, [line(START), line(START + timedelta(seconds=5))])
    stream = lambda: ordered.numbered_sessions(live.live_events(spark, str(source), files_at_once=1))
    run(stream(), out)
    assert spark.read.schema(stream().schema).parquet(f"{out}/rows").count() == 0
    # A row counts as late by the watermark of the batch before.
    feed(source, [line(START + timedelta(hours=3), "9.9.9.9")])
    run(stream(), out)
    feed(source, [line(START + timedelta(seconds=9))])
    late = run(stream(), out)
    rows = spark.read.parquet(f"{out}/rows").collect()
    assert [(r.event_count, r.unique_ports) for r in rows] == [(2, 1)] and live.rows_too_late(late) == 1
    with pytest.raises(ValueError, match="a second"):
        ordered.numbered_sessions(live.live_events(spark, str(source)), SessionConfig(0))


def test_timeline_has_no_holes(spark, tmp_path):
    rng = random.Random(2)
    rows = sorted((START + timedelta(seconds=rng.randrange(8 * 3600)), rng.choice([*analytics.LABELS, None])) for _ in range(60))
    rows = [(t, lab) for t, lab in rows if lab] + [(START + timedelta(days=3), "benign")]
    schema = "ts_dt_utc timestamp, label string"
    for i, part in enumerate((rows[:20], rows[20:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in")).withWatermark("ts_dt_utc", "0 seconds")
        run(ordered.live_timeline(stream), tmp_path / "out")
    minutes = spark.createDataFrame(rows[:-1], schema).groupBy(F.date_trunc("minute", "ts_dt_utc").alias("minute"))
    minutes = minutes.agg(*[F.count_if(F.col("label") == lab).alias(lab) for lab in analytics.LABELS])
    want = sorted(tuple(r) for r in analytics.resample(minutes).select("bucket", *analytics.LABELS).collect())
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out/rows")).collect())
    assert got == want and any(r[1:] == (0, 0, 0) for r in got)


def sunk(spark, out):
    return {k: sorted(tuple(r) for r in sink.read(spark, str(out), k).collect()) for k in sink.KINDS}


def test_sink_writes_every_line_once_and_keeps_late_ones(spark, tmp_path):
    day = lambda h: START + timedelta(hours=h)
    files = [[line(day(1)), "", "not json", line("2024-13-01 00:00:00")], [line(day(5)), line(day(0))], [line(day(4)), line(day(2))], ["[1,2]"]]
    feed(tmp_path / "in", *files)
    stream = sink.writer(read_stream(spark, tmp_path), str(tmp_path / "out"), 2 * 3600)
    stream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    first = sunk(spark, tmp_path / "out")
    lines = read_raw_lines(spark, str(tmp_path / "in"))
    everything = sorted(tuple(r) for r in parse_lines(lines).collect())
    assert sorted(r[:-1] for r in first["events"] + first["late"]) == everything
    assert [(r[0][11:13], r[-1]) for r in first["late"]] == [("02", 2)]  # 00 is within two hours of 01
    assert sorted(r[:-1] for r in first["rejects"]) == sorted(tuple(r) for r in rejected_lines(lines).collect())
    # The same batches once more, as after a crash; and one that stopped half way and is not seen.
    parts = [spark.createDataFrame([(x,) for x in f], "value string") for f in files]
    for n in (1, 2, 3, 2):
        sink.Sink(str(tmp_path / "out"), 2 * 3600)(parts[n], n)
    assert sunk(spark, tmp_path / "out") == first
    sink.Sink(str(tmp_path / "out"))._write(parts[0], "rejects", 4)
    assert sunk(spark, tmp_path / "out") == first


def read_stream(spark, tmp_path):
    from sparkwarden.sources.raw_log import stream_raw_lines

    return stream_raw_lines(spark, str(tmp_path / "in"), 1)


def test_empty_sink(spark, tmp_path):
    assert all(not rows for rows in sunk(spark, tmp_path / "none").values())
    sink.Sink(str(tmp_path / "out"))(spark.createDataFrame([], "value string"), 0)
    assert sink.marks(spark, str(tmp_path / "out")) == {0: None} and sink.read(spark, str(tmp_path / "out"), "late").count() == 0


def test_a_key_costs_few_state_calls(spark):
    """Many stretches of one key in a batch are read and written together, under one timer; a hot stretch is one record."""
    calls, stored = [], {}

    class Value:
        def __init__(self, name):
            self.name = name

        def exists(self):
            return self.name in stored

        def get(self):
            return stored[self.name]

        def update(self, value):
            calls.append(("update", self.name))
            stored[self.name] = value

        def clear(self):
            stored.pop(self.name, None)

    class Handle:
        def getValueState(self, name, *_):
            return Value(name)

        def registerTimer(self, at):
            calls.append(("timer", at))

    import pandas as pd

    gap = 60_000_000
    step = ordered.Sessions(gap)
    step.init(Handle())
    at = [n * 3 * gap for n in range(50)] + [5] * 1000
    rows = pd.DataFrame({"slot": [t - t % gap for t in at], "first": at, "last": at, "src_port": [*range(50), *[7] * 999, None]})
    rows = rows.assign(**dict.fromkeys(ordered.COUNTS, 1))
    assert list(step.handleInputRows(("1.1.1.1", "curl"), iter([rows]), None)) == []
    assert len(calls) == 2  # a call for each of fifty stretches and more before
    wake, held = stored["stretches"]
    assert wake == gap and len(held) == 50 and held[0][1:4] == (0, 5, 1001) and held[0][-1] == [0, 7]


class Store:
    """State of one key, the calls that change it, and its timers."""

    def __init__(self):
        self.stored, self.calls, self.timers = {}, [], set()

    def getValueState(self, name, *_):
        return Stored(self, name)

    def registerTimer(self, at):
        self.calls.append("timer")
        self.timers.add(at)

    def fire(self, step, key, watermark_ms):
        """Rows that the timers up to the watermark give."""
        rows = []
        for at in sorted(t for t in self.timers if t <= watermark_ms):
            for part in step.handleExpiredTimer(key, Clock(watermark_ms), None):
                rows += part.itertuples(index=False, name=None)
            self.timers.discard(at)
        return rows


class Stored:
    def __init__(self, store, name):
        self.store, self.name = store, name

    def exists(self):
        return self.name in self.store.stored

    def get(self):
        return self.store.stored[self.name]

    def update(self, value):
        self.store.calls.append(self.name)
        self.store.stored[self.name] = value

    def clear(self):
        self.store.stored.pop(self.name, None)


class Clock:
    def __init__(self, watermark_ms):
        self.watermark_ms = watermark_ms

    def getCurrentWatermarkInMs(self):
        return self.watermark_ms


def bucket_rows(events):
    """(time, (source, tool), port, hits) as a bucket gets them."""
    import pandas as pd

    columns = {"src_ip": [k[0] for _, k, _, _ in events], "tool": [k[1] for _, k, _, _ in events], "at": [e[0] for e in events]}
    ports = {"src_port": [e[2] or 0 for e in events], "has_port": [int(e[2] is not None) for e in events]}
    return pd.DataFrame(columns | ports).assign(**dict.fromkeys(ordered.COUNTS[1:], 1)).assign(indicator_hits=[e[3] for e in events])


def key_rows(events, gap):
    import pandas as pd

    at = [e[0] for e in events]
    rows = pd.DataFrame({"slot": [t - t % gap for t in at], "first": at, "last": at, "src_port": pd.Series([e[2] for e in events], dtype=object)})
    return rows.assign(**dict.fromkeys(ordered.COUNTS, 1)).assign(indicator_hits=[e[3] for e in events])


def test_keys_of_a_bucket_share_calls():
    """A batch and a timer cost a bucket with two hundred keys as many calls as one with one key."""
    gap = 60_000_000
    step, store = ordered.Buckets(gap), Store()
    step.init(store)
    events = [(n * 3 * gap + k, (f"1.1.1.{k}", "curl"), k, 0) for n in range(5) for k in range(200)]
    assert list(step.handleInputRows((1,), iter([bucket_rows(events[:300]), bucket_rows(events[300:])]), None)) == []
    assert len(store.calls) == 2
    rows = store.fire(step, (1,), 10 * gap // 1000)
    assert len(rows) == 200 * 3 and len(store.calls) == 5


@pytest.mark.parametrize("seed", range(40))
def test_buckets_find_what_single_keys_find(seed):
    """Null tools and ports, ports beyond 53 bits, times before 1970, batches mixed in time."""
    rng = random.Random(seed)
    gap = rng.choice([1_000_000, 7_000_000, 60_000_000])
    start, keys = rng.choice([0, -25 * gap]), [(f"1.{i}", tool) for i in range(3) for tool in ("a", None)]
    events = sorted((start + rng.randrange(rng.choice([3, 40]) * gap), rng.choice(keys), rng.choice([None, 1, 1 << 60, (1 << 60) + 1]), rng.randrange(3)) for _ in range(100))
    step, store = ordered.Buckets(gap), Store()
    step.init(store)
    single = {key: (ordered.Sessions(gap), Store()) for key in keys}
    for s, at in single.values():
        s.init(at)
    got, want, mark = [], [], -(1 << 50)
    for low in range(0, 150, 25):
        part = [e for e in events[low : low + 25] if e[0] > mark * 1000]
        rng.shuffle(part)
        if part:
            list(step.handleInputRows((1,), iter([bucket_rows(part)]), None))
        for key, (s, at) in single.items():
            if mine := [e for e in part if e[1] == key]:
                list(s.handleInputRows(key, iter([key_rows(mine, gap)]), None))
            want += at.fire(s, key, mark)
        got += store.fire(step, (1,), mark)
        mark = max(e[0] for e in part) // 1000 - rng.randrange(gap // 1000) if part else 1 << 50
    want += [r for key, (s, at) in single.items() for r in at.fire(s, key, 1 << 51)]
    got += store.fire(step, (1,), 1 << 51)
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) > 3 and not store.timers


@pytest.mark.parametrize("buckets", [0, 3])
def test_streamed_sessions_by_key_and_by_bucket(spark, tmp_path, buckets):
    lines = [line(START + timedelta(seconds=40 * k), f"1.1.1.{k % 7}", str(k % 3)) for k in range(200)]
    feed(tmp_path / "in", lines[:90], lines[90:], [line(START + timedelta(days=400), "9.9.9.9")])
    cfg = SessionConfig(300, 2)
    run(ordered.numbered_sessions(live.live_events(spark, str(tmp_path / "in"), files_at_once=1), cfg, buckets), tmp_path / "out")
    found = spark.read.parquet(str(tmp_path / "out/rows"))
    assert sorted(tuple(r) for r in found.collect()) == batch(spark, tmp_path / "in", cfg)


def test_steps_are_fed_as_equally_many_files(spark, tmp_path, monkeypatch):
    """A step is written by several tasks, and as many for each step, so that a batch reads a whole step."""
    from sparkwarden.plans import queries

    monkeypatch.setattr(queries, "ROWS_PER_FILE", 20)
    rows = spark.range(300).select(F.col("id").cast("string").alias("value"), (F.col("id") * F.when(F.col("id") < 60, 1).otherwise(3)).alias("at"))
    assert queries._fed(rows, "at", str(tmp_path / "in"), "text", 3, 4) == 4
    files = sorted((p for p in (tmp_path / "in").iterdir() if p.suffix == ".txt"), key=lambda p: p.stat().st_mtime_ns)
    read = [[int(x) for f in files[n : n + 4] for x in f.read_text().split()] for n in range(0, 12, 4)]
    assert len(files) == 12 and sorted(sum(read, [])) == list(range(300))
    assert max(read[0]) < min(read[1]) and max(read[1]) < min(read[2])
    assert queries._fed(rows, "at", str(tmp_path / "one"), "text") == 1 and len(list((tmp_path / "one").glob("*.txt"))) == 3
