import random

from sparkwarden.schemas import EVENTS, conform
from sparkwarden.sources.raw_log import parse_lines, read_raw_lines, rejected_lines

GOOD_TIME = "2024-01-30 07:57:26"


def parse(spark, *lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return [r.asDict() for r in parse_lines(df).collect()]


def one(spark, line):
    rows = parse(spark, line)
    assert len(rows) <= 1
    return rows[0] if rows else None


def test_sample_lines(spark):
    a, b = parse(
        spark,
        '[null,null,"2021-06-01 12:30:45","203.0.113.9","4242","Browser/1","en","203.0.113.9"]',
        '["open","/var/x/../y","2022-02-03 04:05:06","198.51.100.7","555","Robot/2",null,null]',
    )
    assert a["ts"] == "2021-06-01T12:30:45Z" and a["src_port"] == 4242 and a["action1"] is None
    assert a["lang"] == "en" and a["extra"] == "203.0.113.9"
    assert b["action1"] == "open" and b["action2"] == "/var/x/../y" and b["lang"] is None
    assert list(a) == EVENTS.fieldNames()


def test_ports(spark):
    cases = {
        "64940.9": 64940, "true": 1, "false": 0, '" 42 "': 42, '"12.5"': None, '"1_000"': 1000, '"_1"': None,
        "null": None, "[1]": None, '{"a":1}': None, "-7": -7, '"+7"': 7, '"x"': None, "1e300": None,
        "99999999999999999999": None, '"99999999999999999999"': None, "0": 0, '""': None, "1e3": 1000,
    }
    for text, port in cases.items():
        row = one(spark, f'["a","b","{GOOD_TIME}","1.2.3.4",{text},"UA"]')
        assert row is not None and row["src_port"] == port, text


def test_text_slots_take_only_strings(spark):
    row = one(spark, f'[1,{{"a":1,"a":2}},"{GOOD_TIME}",5,true,false,[1],"x","beyond"]')
    assert [row[c] for c in ("action1", "action2", "src_ip", "user_agent", "lang")] == [None] * 5
    assert row["extra"] == "x" and row["src_port"] == 1


def test_escapes_and_brackets_inside_text(spark):
    row = one(spark, f'["a ] b","q\\"\\u00e9\\n","{GOOD_TIME}","1.2.3.4","1","UA [x]; y"]')
    assert row["action1"] == "a ] b" and row["action2"] == 'q"é\n' and row["user_agent"] == "UA [x]; y"


def test_rejected(spark):
    head = f'"a","b","{GOOD_TIME}","i","1","UA"'
    bad = [
        "", " \t", "not json", '{"a":1}', "[1,2]", f"[{head}] tail", f"[{head}],[1]", f"[{head}]]", f"[{head}]}}",
        "['a','b','c','d','e','f']", f"[{head},]", f"[{head},NaN]", f"[{head}", f'[{head},"\\ud800"]',
        f'[{head},"a\tb"]', f'[{head},"\\x"]', f"[{head},01]",
        '["a","b",null,"i","1","UA"]', '["a","b",5,"i","1","UA"]', '["a","b","2024-01-30T07:57:26","i","1","UA"]',
        '["a","b","2024-1-3 7:57:26","i","1","UA"]', f'["a","b","{GOOD_TIME}\\n","i","1","UA"]',
    ]
    df = spark.createDataFrame([(x,) for x in bad], "value string")
    assert [r.raw_line for r in parse_lines(df).collect()] == []
    reasons = [r.reason for r in rejected_lines(df).collect()]
    assert len(reasons) == len(bad)
    assert reasons.count("blank") == 2 and reasons.count("bad_time") == 5


def test_impossible_date_is_still_an_event(spark):
    assert one(spark, '["a","b","2024-13-01 00:00:00","1.2.3.4","1","UA"]')["ts"] == "2024-13-01T00:00:00Z"


def test_plain_and_general_way_agree(spark):
    rng = random.Random(7)
    atoms = ['"a, b"', "null", '"é"', '""', '"x"']
    lines, spaced = [], []
    for _ in range(200):
        slots = [rng.choice(atoms) for _ in range(rng.randint(5, 9))]
        if len(slots) > 2:
            slots[2] = f'"{GOOD_TIME}"'
        if len(slots) > 4:
            slots[4] = rng.choice(['"12"', "12", "null", '"x"'])
        lines.append("[" + ",".join(slots) + "]")
        spaced.append("[\n".strip() + ",".join(slots) + "\r]")  # a control blank takes the general way
    left, right = parse(spark, *lines), parse(spark, *spaced)
    strip = lambda rows: [{k: v for k, v in r.items() if k != "raw_line"} for r in rows]
    assert strip(left) == strip(right) and len(left) > 100


def test_never_raises_and_keeps_count(spark):
    rng = random.Random(3)
    lines = ["".join(rng.choice('[]{}",:\\u0a1 nulltrue') for _ in range(rng.randint(0, 60))) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert parse_lines(df).count() + rejected_lines(df).count() == len(lines)


def test_files(spark, tmp_path):
    line = b'["a","b","2024-01-30 07:57:26","1.2.3.4","1","UA'
    content = line + b'"]\r\n' + line + b'\xff"]\n' + b"x\ry\n" + b"\xc2\xa0" + line + b'"]'
    (tmp_path / "a.log").write_bytes(content)
    (tmp_path / "empty.log").write_bytes(b"")
    lines = read_raw_lines(spark, str(tmp_path))
    events = parse_lines(lines).collect()
    assert len(events) == 3 and {e.user_agent for e in events} == {"UA"}
    assert all(e.raw_line.startswith("[") and e.raw_line.endswith("]") for e in events)
    assert [r.raw_line for r in rejected_lines(lines).collect()] == ["x\ry"]


def test_conform(spark):
    df = spark.createDataFrame([("7", "t", "r"), ("x", None, "s")], "src_port string, ts string, raw_line string")
    rows = conform(df, EVENTS).collect()
    assert [r.src_port for r in rows] == [7, None] and rows[0].src_ip is None
    assert conform(df, EVENTS).columns == EVENTS.fieldNames()
