import random
import uuid
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkwarden.operators import sessionize as S
from sparkwarden.schemas import INDICATOR_COLUMNS, SESSION_EVENTS, SESSIONS
from sparkwarden.sources import tables

START = datetime(2024, 1, 1, tzinfo=UTC)
SCHEMA = (
    "ts string, src_ip string, src_port bigint, user_agent string, action1 string, action2 string, extra string, "
    "raw_line string, tool string, " + ", ".join(f"{c} boolean" for c in INDICATOR_COLUMNS) + ", indicator_count bigint"
)


def event(seconds, ip="1.1.1.1", tool="curl", port=1, hits=0):
    ts = seconds if isinstance(seconds, str) else (START + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")
    flags = [i < hits for i in range(5)]
    return (ts, ip, port, "ua", None, None, None, f"line {seconds} {port}", tool, *flags, hits)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def sessions(spark, rows, **cfg):
    return S.build_sessions(frame(spark, rows), S.SessionConfig(**cfg)).orderBy("src_ip", "tool", "start_ts").collect()


def test_gap_is_strict(spark):
    assert [r.event_count for r in sessions(spark, [event(0), event(600)])] == [2]
    assert [r.event_count for r in sessions(spark, [event(0), event(601)], min_events=1)] == [1, 1]
    assert sessions(spark, [event(0), event(601)]) == []


def test_keys_ids_and_numbers_before_the_filter(spark):
    rows = [event(0), event(5000), event(5001), event(0, tool="wget"), event(1, tool="wget"), event(0, ip="2.2.2.2")]
    found = sessions(spark, rows)
    assert [(r.tool, r.event_count) for r in found] == [("curl", 2), ("wget", 2)]
    assert found[0].session_id == str(uuid.uuid5(uuid.NAMESPACE_URL, "1.1.1.1|curl|2"))
    assert found[1].session_id == str(uuid.uuid5(uuid.NAMESPACE_URL, "1.1.1.1|wget|1"))


def test_rates(spark):
    same, long = sessions(spark, [event(0, "a"), event(0, "a"), event(0, "b"), event(10, "b")])
    assert (same.duration_s, same.rps) == (0.0, 2.0)
    assert (long.duration_s, long.rps) == (10.0, 0.2)


def test_bad_times_and_missing_sources_are_dropped(spark):
    rows = [event("2024-13-01T00:00:00Z"), event("2024-02-30T00:00:00Z"), event("0001-01-01T00:00:00Z")]
    rows += [event(0, ip=None), event(0), event(1)]
    assert [r.event_count for r in sessions(spark, rows, min_events=1)] == [2]


def test_sums_and_null_ports(spark):
    (row,) = sessions(spark, [event(0, port=None, hits=2), event(1, port=7, hits=5), event(2, port=7)])
    assert row.unique_ports == 1 and row.indicator_hits == 7
    assert [row[c] for c in INDICATOR_COLUMNS] == [2, 2, 1, 1, 1]


def random_events(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        hot = rng.random() < 0.4
        ip = "hot" if hot else f"ip{rng.randint(0, 20)}"
        rows.append(event(rng.randint(0, 40_000 if hot else 4_000), ip, rng.choice(["curl", "x"]), rng.randint(1, 9), rng.randint(0, 5)))
    return rows


def brute_force(rows, gap, min_events):
    groups = {}
    for row in rows:
        groups.setdefault((row[1], row[8]), []).append(row)
    out = {}
    for (ip, tool), members in groups.items():
        index, previous, runs = 0, None, []
        for row in sorted(members, key=lambda r: r[0]):
            at = datetime.fromisoformat(row[0])
            if previous is None or (at - previous).total_seconds() > gap:
                index += 1
                runs.append([])
            runs[-1].append(row)
            previous = at
        for i, run in enumerate(runs, 1):
            if len(run) >= min_events:
                name = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{ip}|{tool}|{i}"))
                out[name] = (ip, tool, run[0][0], run[-1][0], len(run), len({r[2] for r in run}), sum(r[-1] for r in run))
    return out


def as_dict(df):
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    cols = ["src_ip", "tool", text("start_ts"), text("end_ts"), "event_count", "unique_ports", "indicator_hits"]
    return {r[0]: tuple(r[1:]) for r in df.select("session_id", *cols).collect()}


@pytest.mark.parametrize("gap,min_events", [(600, 2), (60, 1), (1, 3), (0, 1)])
def test_equals_brute_force(spark, gap, min_events):
    rows = random_events()
    cfg = S.SessionConfig(gap, min_events)
    df = frame(spark, rows).repartition(3)
    want = brute_force(rows, gap, min_events)
    assert as_dict(S.build_sessions(df, cfg)) == want
    labelled = S.label_events(df, cfg)
    assert as_dict(S.sessions_from_events(labelled)) == want
    assert labelled.count() == sum(v[4] for v in want.values())


def test_below_one_second(spark):
    rows = [event(f"2024-01-01T00:00:0{i // 4}.{i % 4 * 25:02d}Z") for i in range(12)]
    for gap in (0, 1):
        found = as_dict(S.build_sessions(frame(spark, rows), S.SessionConfig(gap, 1)))
        assert len(found) == (12 if gap == 0 else 1)


def test_hot_source_is_few_rows_to_the_window(spark):
    """A source with nearly all events, within an hour, reaches the window as its stretches."""
    rows = [event(f"2024-01-01T00:{i % 60:02d}:{i // 60 % 60:02d}Z") for i in range(3000)]
    timed = S.with_event_time(frame(spark, rows))
    cfg = S.SessionConfig(600, 1)
    stretches = S._with_stretch(timed, cfg).select(*S.KEYS, "_slot").distinct()
    assert stretches.count() == 6 and as_dict(S.build_sessions(frame(spark, rows), cfg)) == brute_force(rows, 600, 1)


def test_plans_read_once_and_twice(spark, tmp_path):
    frame(spark, random_events(50)).write.parquet(f"{tmp_path}/e")
    events = spark.read.parquet(f"{tmp_path}/e")
    for df, scans in ((S.build_sessions(events), 1), (S.label_events(events), 2)):
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert final.count("FileScan") == scans and "Python" not in final and "SinglePartition" not in final


def test_time_zone_is_checked(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            S.with_event_time(frame(spark, [event(0)]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_written_tables(spark, tmp_path):
    df, cfg, out = frame(spark, random_events()), S.SessionConfig(), str(tmp_path / "out")
    for _ in range(2):  # a second run replaces the first
        tables.write_session_outputs(df, out, cfg)
    found = tables.read_table(spark, f"{out}/sessions.parquet", SESSIONS)
    assert as_dict(found) == as_dict(S.build_sessions(df, cfg))
    events = tables.read_table(spark, f"{out}/session_events", columns=["session_id", "ts"])
    assert events.count() == found.agg(F.sum("event_count")).first()[0]
    tables.write_session_outputs(frame(spark, []), out, cfg)
    empty = spark.read.parquet(f"{out}/session_events")
    assert empty.count() == 0 and empty.columns == SESSION_EVENTS.fieldNames()
