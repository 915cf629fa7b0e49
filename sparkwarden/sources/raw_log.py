"""Raw log lines: one JSON array per line, six to eight positional slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.schemas import EVENTS

# Slot order of a line and the accepted time shape.
SLOTS = ["action1", "action2", "ts", "src_ip", "src_port", "user_agent", "lang", "extra"]
MIN_SLOTS = 6
TS_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"

_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"
_INT_TEXT = r"(?U)^[\s\x1c-\x1f]*[+-]?[0-9]+(_[0-9]+)*[\s\x1c-\x1f]*\z"
# A \uD8xx escape without its \uDCxx partner, or the reverse, is not valid JSON text.
_LONE_HIGH = r"(?<!\\)(?:\\\\)*\\u[dD][89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F])"
_LONE_LOW = r"(?<!\\u[dD][89abAB][0-9a-fA-F]{2})(?<!\\)(?:\\\\)*\\u[dD][c-fC-F][0-9a-fA-F]{2}"
# A plain line: at least six slots, all null or text without escapes; the fifth may be a whole number.
_PLAIN = r'[ \t]*+(?:null|"[^"\\\x00-\x1f]*+")[ \t]*+'
_PLAIN_LINE = rf'^\[(?:{_PLAIN},){{4}}(?:{_PLAIN}|[ \t]*+-?(?:0|[1-9][0-9]*+)[ \t]*+),{_PLAIN}(?:,{_PLAIN})*+\]\z'


def read_raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines split at ``\\n`` only; files split into ranges, so one big file is read by many tasks."""
    return spark.read.option("lineSep", "\n").text(path)


def stream_raw_lines(spark: SparkSession, path: str, files_at_once: int | None = None) -> DataFrame:
    """New files as they come, by their time; ``files_at_once`` bounds a batch."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.text(path)


def clean_line(value: Column) -> Column:
    """Undecodable bytes dropped, then blanks of any script trimmed at both ends."""
    text = F.when(F.is_valid_utf8(value), value).otherwise(
        F.replace(F.make_valid_utf8(value), F.lit("\ufffd"), F.lit(""))
    )
    bare = value.startswith("[") & value.endswith("]")
    return F.when(bare & F.is_valid_utf8(value), value).otherwise(F.regexp_replace(text, _BLANKS, ""))


def _slot(doc: Column, index: int, kind: str = "variant") -> Column:
    return F.try_variant_get(doc, f"$[{index}]", kind)


def _text_slot(plain: Column, doc: Column, index: int) -> Column:
    """The slot when it is a JSON string, else null: numbers and booleans are not turned into text."""
    typed = F.when(F.schema_of_variant(_slot(doc, index)) == "STRING", _slot(doc, index, "string"))
    return F.when(plain.isNotNull(), F.get(plain, F.lit(index))).otherwise(typed)


def _int_text(text: Column) -> Column:
    digits = F.regexp_replace(text, r"(?U)[_\s\x1c-\x1f]", "")
    return F.coalesce(text.try_cast("bigint"), F.when(text.rlike(_INT_TEXT), digits.try_cast("bigint")))


def _int_slot(plain: Column, doc: Column, index: int) -> Column:
    """Numbers (cut toward zero), booleans and integer text; anything else, or beyond 64 bits, is null."""
    kind = F.schema_of_variant(_slot(doc, index))
    is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | kind.startswith("DECIMAL")
    typed = F.when(kind == "STRING", _int_text(_slot(doc, index, "string"))).when(
        is_number, _slot(doc, index, "bigint")
    )
    return F.when(plain.isNotNull(), _int_text(F.get(plain, F.lit(index)))).otherwise(typed)


def _documents(lines: DataFrame, column: str) -> DataFrame:
    """``raw_line`` and its array: ``_plain`` text slots, or else ``_doc``; both null for anything but one array.

    One regular expression recognises plain lines, nearly all of them, from end to end; their slots are text or
    null, which a typed JSON reader gives quickly. Other lines become a variant. The variant parser stops after the
    first JSON value, so such a line is parsed inside brackets, where text left over breaks the document. A line
    whose first closing bracket is its last character cannot hide any; others are parsed once more inside braces.

    Both leave through ``inline``: a filter further up is not pushed below it, so that no line is parsed a second
    time just to be tested.
    """
    clean = lines.select(clean_line(F.col(column)).alias("raw_line"))
    raw = F.col("raw_line")
    is_plain = raw.rlike(_PLAIN_LINE)
    first = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))), "$[0]", "variant")
    wrapped = F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}")))
    complete = (F.instr(raw, "]") == F.length(raw)) | wrapped.isNotNull()
    paired = ~raw.contains("\\u") | ~(raw.rlike(_LONE_HIGH) | raw.rlike(_LONE_LOW))
    whole = raw.startswith("[") & raw.endswith("]") & complete & paired
    slots = F.when(is_plain, F.from_json(raw, "array<string>")).alias("_plain")
    checked = clean.select("raw_line", F.inline(F.array(F.struct(slots))))
    doc = F.when(F.col("_plain").isNull() & whole, first).alias("_doc")
    return checked.select("raw_line", "_plain", F.inline(F.array(F.struct(doc))))


def _with_fields(lines: DataFrame, column: str) -> DataFrame:
    """Line, whether it has enough slots, and its typed fields."""
    plain, doc = F.col("_plain"), F.col("_doc")
    fields = [_text_slot(plain, doc, i).alias(f"_{name}") for i, name in enumerate(SLOTS) if name != "src_port"]
    port = _int_slot(plain, doc, SLOTS.index("src_port")).alias("_src_port")
    enough = (plain.isNotNull() | _slot(doc, MIN_SLOTS - 1).isNotNull()).alias("_enough")
    return _documents(lines, column).select("raw_line", F.inline(F.array(F.struct(enough, port, *fields))))


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Raw lines to events; lines that are no event are left out. One narrow job, no Python per row."""
    good = _with_fields(lines, column).filter(F.col("_enough") & F.col("_ts").rlike(TS_SHAPE))
    time = F.concat(F.substring("_ts", 1, 10), F.lit("T"), F.substring("_ts", 12, 8), F.lit("Z"))
    rest = [F.col(f"_{name}").alias(name) for name in EVENTS.fieldNames()[1:-1]]
    return good.select(time.alias("ts"), *rest, "raw_line")


def rejected_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines ``parse_lines`` leaves out, each with the reason."""
    reason = (
        F.when(F.col("raw_line") == "", "blank")
        .when(~F.col("_enough"), "not_an_array_of_six")
        .when(~F.coalesce(F.col("_ts").rlike(TS_SHAPE), F.lit(False)), "bad_time")
    )
    return _with_fields(lines, column).select("raw_line", reason.alias("reason")).filter(reason.isNotNull())
