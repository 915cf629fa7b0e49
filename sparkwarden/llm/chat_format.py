"""Multi-party chat rendering with rotating perspective. DataFrame functions only.

For every participant of a conversation the dialogue is rendered once: that speaker's turns as ``assistant``, the
others' as named users, system turns as ``system``. Only the participant's own words and the end mark behind them count
for training; ``mask_start`` and ``mask_end`` say where they lie. A rendering is the ``piece`` texts in order of
``seq``, and offsets are code points in it, so that long conversations are never gathered in one row or task.

Texts take no part in the ordering. Turns get a number and are written; their keys, the first ``PREFIX`` characters
and the length of the text are sorted by range, so that a conversation of any size lies in as many tasks as its share
asks for, equal rows included. Positions are sums inside blocks of neighbours, added up over blocks, for each
perspective. The texts are joined to them by number at the end, which is the only time that they are shuffled.

Defined results: turns go by (turn, role, text), nulls first; equal rows stay and are interchangeable. A null text is
empty. Different texts of one conversation, turn and role that agree in their first ``PREFIX`` characters are put in
order in one task, each once. A null or empty role is the participant ``unknown``. Rows with a null conv_id are one
conversation. A conversation with only system turns has no participant and no rows. Control marks inside texts are
broken up with a space, so that no text can open or close a turn. Extra columns are not looked at. Empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkwarden.llm.common import table
from sparkwarden.session import discard, materialize

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"
# Neighbours in the order of turns whose sizes are summed together.
BLOCK = 65_536
# Characters of a text that are sorted with the keys; only texts that agree in them are compared as a whole.
PREFIX = 64


def _clean(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _role(own: Column) -> Column:
    return F.when(own, "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user")


def _head(own: Column) -> Column:
    """The line that opens a turn."""
    name = F.when(_role(own) == "user", F.concat(F.lit(" name="), _name())).otherwise("")
    return F.concat(F.lit(OPEN), _role(own), name, F.lit("\n"))


def _name() -> Column:
    return F.regexp_replace(F.col("speaker"), r"[\s<>|]+", "_")


def _numbered(conversations: DataFrame) -> DataFrame:
    """Turns with a number of their own, written, as numbers must not change; ``conv`` is never null."""
    role = F.coalesce(F.when(F.col("role") != "", F.col("role")), F.lit("unknown"))
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    turns = conversations.select(
        "conv_id", conv.alias("conv"), "turn", role.alias("speaker"), F.coalesce("text", F.lit("")).alias("said"),
        F.monotonically_increasing_id().alias("id"),
    )
    return materialize(turns, "turns")


def _in_order(turns: DataFrame) -> DataFrame:
    """``id, conv, speaker, chars`` and ``pos``, which grows with (conv, turn, speaker, said)."""
    prefix = F.left("said", F.lit(PREFIX))
    cell, digest = F.xxhash64("conv", "turn", "speaker", prefix).alias("cell"), F.unhex(F.md5("said")).alias("digest")
    kinds = turns.select(cell, digest).groupBy("cell").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"))
    tied = materialize(kinds.where("lo != hi").select("cell"), "tied")
    texts = turns.select(cell, digest, "said").join(tied, "cell").dropDuplicates(["cell", "digest"])
    rest = F.row_number().over(W.partitionBy("cell").orderBy("said")).alias("rest")
    ranks = materialize(texts.select("cell", "digest", rest), "ranks")
    chars = F.length(_clean(F.col("said"))).cast("long").alias("chars")
    keys = turns.select("id", "conv", "turn", "speaker", prefix.alias("prefix"), chars, cell, digest)
    keys = keys.join(ranks, ["cell", "digest"], "left").drop("cell", "digest")
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "speaker", "prefix", "rest", "id")]
    line = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    line = materialize(line.select("id", "conv", "speaker", "chars", F.monotonically_increasing_id().alias("pos")), "line")
    discard(tied, ranks)
    return line


def _positions(line: DataFrame, block: int) -> DataFrame:
    """``id, perspective, seq, start`` of every turn in every rendering of its conversation."""
    line = line.withColumn("block", F.expr(f"pos div {int(block)}"))
    views = line.where(F.col("speaker") != SYSTEM).select("conv", F.col("speaker").alias("perspective")).distinct()
    # Views go to the blocks of their conversation first, so that a long conversation meets them block by block.
    views = line.select("conv", "block").distinct().join(views, "conv")
    own = F.col("speaker") == F.col("perspective")
    size = F.length(_head(own)) + F.col("chars") + len(CLOSE)
    sized = line.join(views, ["conv", "block"]).select("id", "conv", "perspective", "block", "pos", size.alias("size"))
    key = ["conv", "perspective"]
    sums = sized.groupBy(*key, "block").agg(F.count("*").alias("n"), F.sum("size").alias("chars"))
    before = W.partitionBy(*key).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = sums.select(*key, "block", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"base_{c}") for c in ("n", "chars")))
    within = W.partitionBy(*key, "block").orderBy("pos")
    placed = sized.select(
        "id", *key, "block", "size", F.row_number().over(within).alias("at"),
        F.sum("size").over(within.rowsBetween(W.unboundedPreceding, 0)).alias("up_to"),
    )
    return placed.join(base, [*key, "block"]).select(
        "id", "perspective", (F.col("base_n") + F.col("at") - 1).alias("seq"),
        (F.col("base_chars") + F.col("up_to") - F.col("size")).alias("start"),
    )


def rotate(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation, perspective and turn; ``block`` is the number of neighbours that are summed together."""
    turns = _numbered(conversations)
    line = _in_order(turns)
    own = F.col("speaker") == F.col("perspective")
    piece = F.concat(_head(own), _clean(F.col("said")), F.lit(CLOSE))
    end = F.col("start") + F.length("piece")
    masked = lambda c: F.when(own, c)
    rendered = turns.drop("conv").join(_positions(line, block), "id").withColumn("piece", piece)
    return rendered.select(
        "conv_id", "perspective", "seq", "turn", _role(own).alias("role"), F.when(_role(own) == "user", _name()).alias("name"),
        "piece", "start", end.alias("end"), masked(F.col("start") + F.length(_head(own))).alias("mask_start"),
        # The line feed after the end mark belongs to nobody.
        masked(end - 1).alias("mask_end"),
    )


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))
