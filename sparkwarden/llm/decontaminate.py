"""Benchmark decontamination by windows of normalised words. DataFrame functions only.

A window is ``size`` consecutive words of a benchmark item; an item of fewer words is one window. The distinct windows
are the set that is looked for: a document's windows of the same lengths are joined with it on the words themselves, so
a hit is a hit and needs no second look. The set is broadcast while it is small by count and bytes, and joined by
shuffle beyond that, with the same rows. Texts are cut into blocks of words that overlap by a window less one, so that
no row ever holds the windows of a very long text.

Defined results: null and empty texts have no words and hit nothing; an item without words is no window; a null
item_id counts as the id ``null``; items or documents that repeat count as one item, and one row per document. Hits of a
document are worked out per (doc_id, text), so rows that share an id with different texts stay apart. Extra columns stay
with their rows in ``clean``. An empty benchmark hits nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkwarden.llm.common import ascii_lower, packed, table, unpacked
from sparkwarden.session import discard, materialize

SIZE = 10
BLOCK = 1024
# The windows travel to every executor only below this many bytes of text.
BROADCAST_BYTES = 64 << 20
# Up to so many windows, a place is looked at only if its first words start a window; beyond, every place is joined.
STARTS, KEY = 20_000, 3
# What separates words after lower-casing: all of ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Replacing and splitting is four times as fast as extracting every match."""
    spaced = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN, " "))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def _grams(words: Column, size: int) -> Column:
    """All windows of ``size`` words, by place."""
    gram = lambda at: F.concat_ws(" ", *(F.get(words, at + i) for i in range(size)))
    last = F.size(words) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), gram))


def benchmark_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``gram``, its number of words ``size`` and the ids of the items that hold it."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words_of(F.col("text")).alias("w"))
    long = items.where(F.size("w") >= size).select("item", F.explode(_grams(F.col("w"), size)).alias("gram"), F.lit(size).alias("size"))
    short = items.where((F.size("w") > 0) & (F.size("w") < size)).select("item", F.concat_ws(" ", "w").alias("gram"), F.size("w").alias("size"))
    return long.union(short).groupBy("gram", "size").agg(F.sort_array(F.collect_set("item")).alias("items"))


def find_hits(docs: DataFrame, windows: DataFrame, size: int = SIZE) -> DataFrame:
    """Occurrences of windows in ``docs`` (doc_id, text), and how many words there are, in one pass over the texts.

    ``doc_id, text_hash, at, size, items``: a window of ``size`` words at the word ``at``. Rows without ``size`` are
    one for each block: ``n_words`` of it, and ``at`` where it starts.
    """
    found = windows.groupBy("size").agg(F.sum(F.length("gram") + 40 * F.size("items")), F.count("*")).collect()
    sizes = sorted(r[0] for r in found)  # at most ``size`` lengths
    small = sum(r[1] for r in found) <= BROADCAST_BYTES
    starting = _starts(windows) if sum(r[2] for r in found) <= STARTS else {}
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)), F.lit(BLOCK))
    cut = F.transform(starts, lambda s: F.struct(s.alias("s"), F.slice("w", s + 1, F.lit(BLOCK + size - 1)).alias("w")))
    # The outer forms, as these arrays are never empty: for the others a filter would work them out a second time.
    blocks = words.select("doc_id", "text_hash", F.inline_outer(cut))
    rows = ["array(named_struct('at', s, 'gram', cast(null as string), 'n_words', least(size(w), %d)))" % BLOCK]
    for n in sizes:
        places = f"if(size(w) < {n}, cast(array() as array<int>), sequence(0, least(size(w) - {n}, {BLOCK - 1})))"
        if n in starting:
            key = ", ".join(f"get(w, i + {j})" for j in range(min(n, KEY)))
            places = f"filter({places}, i -> xxhash64({key}) in ({', '.join(map(str, starting[n]))}))"
        gram = ", ".join(f"get(w, i + {j})" for j in range(n))
        rows.append(f"transform({places}, i -> named_struct('at', s + i, 'gram', concat_ws(' ', {gram}), 'n_words', cast(null as int)))")
    places = blocks.select("doc_id", "text_hash", F.expr(f"inline_outer(concat({', '.join(rows)}))"))
    if small:
        hits = places.join(F.broadcast(windows), "gram", "left").where("size is not null or n_words is not null")
    else:
        counted = places.where("n_words is not null").selectExpr("*", "cast(null as int) as size", "cast(null as array<string>) as items")
        hits = places.where("n_words is null").join(windows, "gram").unionByName(counted)
    return hits.select("doc_id", "text_hash", "at", "n_words", "size", "items")


def _starts(windows: DataFrame) -> dict[int, list[int]]:
    """For each window length, the hashes of the words that its windows start with."""
    w = F.split("gram", " ")
    found = {}
    for n in {r[0] for r in windows.select("size").distinct().collect()}:
        key = F.xxhash64(*(F.get(w, F.lit(j)) for j in range(min(n, KEY))))
        found[n] = sorted(r[0] for r in windows.where(F.col("size") == n).select(key).distinct().collect())
    return found


def summarise(hits: DataFrame) -> DataFrame:
    """Per document: words inside any hit, each once, and the items that were hit."""
    order = W.partitionBy("doc_id", "text_hash").orderBy("at", "size")
    reach = F.max(F.col("at") + F.col("size")).over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("at") + F.col("size") - F.greatest(F.coalesce(reach, F.lit(0)), F.col("at")))
    return (
        hits.withColumn("fresh", fresh)
        .groupBy("doc_id", "text_hash")
        .agg(F.sum("fresh").alias("n_hit"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    )


def judge(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Per document: its words, hit words, hit items, and whether it is contaminated."""
    windows = materialize(benchmark_windows(benchmark, size), "windows")
    found = materialize(find_hits(docs.select("doc_id", "text"), windows, size), "hits")
    discard(windows)
    blocks = found.where("size is null").groupBy("doc_id", "text_hash", "at").agg(F.sum("n_words").alias("n"), F.count("*").alias("rows"))
    # Rows that repeat a document have equal blocks: each block is there once for each of them.
    rows = blocks.groupBy("doc_id", "text_hash").agg(F.sum(F.col("n") / F.col("rows")).cast("long").alias("n_words"), F.max("rows").alias("rows"))
    rows = rows.select("doc_id", "text_hash", "n_words", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy"))
    hit = summarise(found.where("size is not null")).select(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"), "n_hit", "items")
    both = rows.join(hit, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("hash")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return both.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array(items)), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, with all their columns."""
    windows = materialize(benchmark_windows(benchmark, size), "windows")
    hits = find_hits(docs.select("doc_id", "text"), windows, size).where("size is not null")
    hits = materialize(hits.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash")).distinct(), "hits")
    discard(windows)
    rows = packed(docs, "doc_id", F.xxhash64("text").alias("__hash"))
    return unpacked(rows.join(hits, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("__hash") == F.col("hash")), "left_anti"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
