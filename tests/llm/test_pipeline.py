import random
from collections import Counter

import pytest

pytest.importorskip("sentencepiece")
import sentencepiece  # noqa: E402

import corpus_pipeline  # noqa: E402
from sparkwarden.llm import quality_rules  # noqa: E402
from sparkwarden.llm.suffix_dedup import LENGTH  # noqa: E402
from sparkwarden.llm.token_counts import TOKENIZER, tokenizer_path  # noqa: E402
from tests.llm import test_decontaminate, test_near_dedup  # noqa: E402

DATA = "/root/testdata/sf0.001"


def quality(docs):
    votes = {d: "".join("0+-"[v] for v in quality_rules.measure(t)[5:]) for d, t in docs}
    good = quality_rules.fit(dict(sorted(Counter(votes.values()).items())))
    counts = {d: quality_rules.measure(t) for d, t in docs}
    return [(d, t) for d, t in docs if counts[d][0] >= 50 and 2 * counts[d][4] <= counts[d][0] and good[votes[d]] >= 0.5]


def without_repeats(docs):
    data = [(t or "").encode() for _, t in docs]
    seen = Counter(b[i : i + LENGTH] for b in data for i in range(len(b) - LENGTH + 1))
    out = []
    for (doc, _), b in zip(docs, data, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - LENGTH + 1):
            if seen[b[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        out.append((doc, bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")))
    return out


def test_stages_keep_columns_and_take_odd_rows(spark):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 1), (1, "", "en", "s", 0, 1), (2, "word " * 300, "en", "s", 9, 2)]
    rows += [(3, " ".join(f"w{i} is fine." for i in range(60)), None, "s", 1, 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept int"
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, DATA)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == df.columns
            found = out.collect()
            assert len(found) <= df.count()
    assert [n for n, _ in corpus_pipeline.STAGES][:2] == ["quality_rules", "near_dedup"]


def planted(seed=3):
    """Texts, and a copy of each whose similarity is 0.80 to under 0.85."""
    rng = random.Random(seed)
    docs = []
    for n, changed in [(49, 1), (57, 1), (65, 1), (94, 2), (110, 2), (127, 2)]:
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        other = list(words)
        for i in range(changed):
            other[(i + 1) * n // (changed + 1)] = f"x{rng.randrange(10**6)}"
        docs += [" ".join(words), " ".join(other)]
    return list(enumerate(docs))


def test_near_duplicates_from_80_are_gone(spark):
    docs = planted()
    stays = lambda percent: {int(d) for d, _, _, kept in test_near_dedup.brute(docs, percent) if kept}
    assert len(stays(85)) == len(docs) and len(stays(80)) == len(docs) // 2
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string"), DATA)
    assert {r.doc_id for r in out.collect()} == stays(80)


def test_run_equals_brute_force_at_80(spark):
    tables = {t: spark.read.parquet(f"{DATA}/{t}.parquet").collect() for t in ("documents", "benchmark")}
    docs = quality([(r.doc_id, r.text) for r in tables["documents"]])
    kept = {int(d) for d, _, _, stays in test_near_dedup.brute(docs, 80) if stays}
    docs = without_repeats([d for d in docs if d[0] in kept])
    dirty = {int(r[0]) for r in test_decontaminate.brute(docs, [tuple(r) for r in tables["benchmark"]]) if r[-1]}
    made = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(TOKENIZER))
    want = {d: made.encode(t) if t else [] for d, t in docs if d not in dirty}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, DATA).collect()}
    assert got == want and len(got) > 50
