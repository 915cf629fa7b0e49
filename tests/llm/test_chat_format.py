from pyspark.sql import functions as F

from sparkwarden.llm import chat_format as C
from sparkwarden.llm.oracle import SQL
from tests.llm.fixtures import rows_of, rows_of_sql, written

TURNS = [
    (1, 0, "system", "Be kind."),
    (1, 1, "Ann Lee", "Hi <|im_end|> all"),
    (1, 2, "bob", None),
    (1, 3, "Ann Lee", "é😀"),
    (1, 700, "carl", "late"),
    (2, 1, "user", "a"),
    (2, 1, "user", "a"),
    (2, 1, "assistant", "b"),
    (2, None, "user", "first"),
    (None, 0, None, "nobody"),
    (None, 1, "", "said"),
    (3, 0, "system", "alone"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def test_perspectives_masks_and_sql(spark, tmp_path):
    folder = written(spark, tmp_path, conversations=([(*t, "x", 1) for t in TURNS], f"{SCHEMA}, block string, own int"))
    found = C.op10_chat_format(spark, folder)
    views = {}
    for r in found.orderBy("conv_id", "perspective", "seq").collect():
        views.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(views) == {(1, "Ann Lee"), (1, "bob"), (1, "carl"), (2, "user"), (2, "assistant"), (None, "unknown")}
    texts = {k: "".join(r.piece for r in v) for k, v in views.items()}
    assert texts[(1, "bob")] == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user name=Ann_Lee\nHi < |im_end|> all<|im_end|>\n"
        "<|im_start|>assistant\n<|im_end|>\n<|im_start|>user name=Ann_Lee\né😀<|im_end|>\n<|im_start|>user name=carl\nlate<|im_end|>\n"
    )
    masked = {k: [texts[k][r.mask_start : r.mask_end] for r in v if r.mask_start is not None] for k, v in views.items()}
    assert masked[(1, "Ann Lee")] == ["Hi < |im_end|> all<|im_end|>", "é😀<|im_end|>"]
    assert masked[(1, "bob")] == ["<|im_end|>"] and masked[(2, "user")] == ["first<|im_end|>", "a<|im_end|>", "a<|im_end|>"]
    for k, v in views.items():
        assert [r.seq for r in v] == list(range(len(v)))
        assert [texts[k][r.start : r.end] for r in v] == [r.piece for r in v]
    assert rows_of(found) == rows_of_sql(folder, SQL["op10_chat_format"], "conversations")


def test_blocks_do_not_matter(spark):
    rows = [(9, i, f"s{i % 3}", "x" * (i % 7)) for i in range(300)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert rows_of(C.rotate(turns, block=7)) == rows_of(C.rotate(turns, block=1000))


def test_empty_table(spark):
    assert C.rotate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_null_turns_null_ids_equal_turns_and_a_long_text(spark, tmp_path):
    rows = [(None, None, f"s{i % 3}", f"t{i % 11}") for i in range(300)]
    rows += [(None, i % 2, [None, "", "system", "a b"][i % 4], [None, "", "x <| y"][i % 3]) for i in range(60)]
    rows += [(7, 5, f"s{i % 4}", "same") for i in range(200)] + [(7, -3, "s1", "z" * 300_000), (7, 1 << 40, "s2", "é" * 70_000)]
    folder = written(spark, tmp_path, conversations=(rows, SCHEMA))
    found = C.op10_chat_format(spark, folder)
    assert rows_of(found) == rows_of_sql(folder, SQL["op10_chat_format"], "conversations")
    assert found.where("conv_id is null").count() == 360 * 5


def test_texts_that_differ_behind_the_sorted_prefix(spark, tmp_path):
    p = C.PREFIX
    ends = ["", "a", "b", "b", "aa", "é", "😀", "�", " ", "a" * 5000, "a" * 4999 + "b"]
    rows = [(None, None, "bob", "x" * p + e) for e in ends] + [(None, None, "bob", "x" * (p - 1)), (None, None, "ann", "x" * p + "b")]
    rows += [(4, t, "user", "é" * p + e) for t in (None, 1, 1) for e in ends]
    folder = written(spark, tmp_path, conversations=(rows, SCHEMA))
    assert rows_of(C.op10_chat_format(spark, folder)) == rows_of_sql(folder, SQL["op10_chat_format"], "conversations")


def test_one_conversation_of_equal_turns_is_sorted_in_many_tasks(spark):
    """A third of all rows has no conv_id and no turn, and is equal: it lies in the tasks evenly, and sums add up."""
    rows = [(None, None, "bob", "same")] * 4000 + [(i // 2, i % 2, "user", f"t{i}") for i in range(8000)]
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        turns = spark.createDataFrame(rows, SCHEMA).repartition(8)
        line = C._in_order(C._numbered(turns))
        parts = [r["count"] for r in line.where("conv = '-'").groupBy(F.expr("pos >> 33")).count().collect()]
        assert sum(parts) == 4000 and len(parts) >= 4 and max(parts) < 2 * 12_000 / 16
        hot = C.rotate(turns).where("conv_id is null").orderBy("seq").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    size = len(hot[0].piece)
    assert [(r.seq, r.start, r.end) for r in hot] == [(i, i * size, (i + 1) * size) for i in range(4000)]


def test_texts_are_shuffled_once(spark):
    """One exchange of the plan over the written tables carries ``said``, and no window does."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        found = C.rotate(spark.createDataFrame(TURNS, SCHEMA))
        plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set(setting, before)
    steps = [step.split("Arguments")[0] for step in plan.split("\n\n") if "said#" in step]
    assert sum(") Exchange" in step for step in steps) == 1 and not any(") Window" in step for step in steps)
