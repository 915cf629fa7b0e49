import random
import sys
import tracemalloc

import numpy as np
import pytest

pytest.importorskip("sentencepiece")
import sentencepiece  # noqa: E402

from sparkwarden.llm import common  # noqa: E402
from sparkwarden.llm import piece_coding as P  # noqa: E402
from sparkwarden.llm import token_counts as T  # noqa: E402

PATH = T.tokenizer_path(T.TOKENIZER)
RNG = random.Random(2)
ODD = [
    "", None, " ", "a  b", " a", "a ", "a\nb c", "▁a", "<s>a</s>", "x ▁  y", "\n \n", "a\x00b", "日本語のテキスト 漢字", "🙂🙂 x",
    "ha" * 300, "=-" * 50 + "====", *(" " * k + "z" for k in range(1, 40)), "word " * 5000, "nospace" * 4000,
    *("".join(RNG.choice("abcehiorstn  .,\n-éß日0123=_/{}") for _ in range(RNG.randint(1, 60))) for _ in range(300)),
]


@pytest.fixture(scope="module")
def library():
    made = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return [made.encode(t) if t else [] for t in ODD]


def test_counts_and_ids_equal_the_library(library):
    assert T.count_batch(ODD, PATH) == [len(x) for x in library]
    assert [x.tolist() for x in P.encode_batch(ODD, PATH)] == library


def test_round_trip(library):
    for text, ids in zip(ODD, library, strict=True):
        assert P.decode(np.array(ids, dtype=np.int64), PATH) == (text or "").replace("▁", " ")


def test_suffix_array_and_occurrences():
    pieces = P.pieces_of(PATH)
    text = "▁the▁thing\0▁thin▁in\0the\0"
    codes = np.array([ord(c) if c != "\0" else 0 for c in text], dtype=np.int64)
    order = P.suffix_array(codes, pieces.depth)
    suffixes = [text[i:].split("\0")[0] if text[i] != "\0" else "" for i in order]
    assert suffixes == sorted(suffixes)
    low, high = P.occurrences(codes, order, pieces)
    for piece in ("in", "▁the", "th", "zu"):
        row = pieces.ids.tolist().index(pieces.id[piece])
        want = [i for i in range(len(text)) if text.startswith(piece, i)]
        assert sorted(order[low[row] : high[row]].tolist()) == want


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(T, "REMEMBERED", 0)
    monkeypatch.setattr(P, "REMEMBERED", 0)
    monkeypatch.setattr(P, "REMEMBERED_PAIRS", 10)
    monkeypatch.setattr(P, "TEXT", 50)
    for i in range(0, len(ODD), 60):
        assert T.count_batch(ODD[i : i + 60], PATH) == [len(x) for x in library[i : i + 60]]
        assert [x.tolist() for x in P.encode_batch(ODD[i : i + 60], PATH)] == library[i : i + 60]


def test_rows(spark, library):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(1, None, 2), (None, "a b", 3), (3, ODD[3], 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(3)
    found = T.count_tokens(docs, ["doc_id"], limit=100)
    assert found.count() == len(rows)
    by = {r.doc_id: r for r in found.collect()}
    for i, t in enumerate(ODD):
        assert tuple(by[i])[1:] == (len((t or "").encode()), len(library[i]), len(library[i]) > 100)
    coded = {r.doc_id: r for r in P.coded(docs, ["doc_id"]).collect()}
    assert all(coded[i].ids == library[i] and coded[i].round_trip for i in range(len(ODD)))
    texts = {r.doc_id: r.text for r in P.decoded(P.encode(docs, ["doc_id"]), ["doc_id"]).collect()}
    assert all(texts[i] == (t or "").replace("▁", " ") for i, t in enumerate(ODD))
    assert T.count_tokens(docs.limit(0), ["doc_id"]).count() == P.coded(docs.limit(0), ["doc_id"]).count() == 0


def test_memory_of_parts_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(T, "_COUNTS", {})
    known = P.pieces_of(PATH).known
    whole = [chr(0x4E00 + i) * 5000 for i in range(40)]
    want = [len(x) for x in P.encode_batch(whole, PATH)]
    assert T.count_batch(whole, PATH) == want
    # Whole texts without spaces are not kept, however few they are.
    assert not any(len(p) > T.LONGEST for m in (known, T._COUNTS[PATH]) for p in m)
    monkeypatch.setattr(T, "REMEMBERED", 50_000)
    monkeypatch.setattr(P, "REMEMBERED", 50_000)
    for start in range(0, 3000, 100):
        some = [f"w{i}" for i in range(start, start + 100)]
        assert T.count_batch(some, PATH) == [len(x) for x in P.encode_batch(some, PATH)]
        for m in (known, T._COUNTS[PATH]):
            assert sum(map(sys.getsizeof, [*m, *m.values()])) <= m.held < 100_000


def test_equal_parts_of_a_batch_are_held_once():
    texts = [f"{'ab cd ' * 10_000}{i}" for i in range(40)]
    P.encode_batch(texts[:1], PATH)
    tracemalloc.start()
    ids = P.encode_batch(texts, PATH)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 800,000 parts: as objects of their own they took over 50 MB.
    assert sum(map(len, ids)) >= 800_000 and peak < 30 << 20


def test_a_task_leaves_nothing_in_its_worker(spark, tmp_path):
    P.encode_batch(["some parts to remember"], PATH)
    P.forget(PATH)
    assert not P.pieces_of(PATH).known and P.pieces_of(PATH).known.held == 0
    docs = spark.createDataFrame([(i, "a b") for i in range(8)], "doc_id long, text string").repartition(2)
    seen = lambda: open(f"{tmp_path}/ended", "a").write("x")  # noqa: E731, SIM115
    assert common.map_texts(docs, "text", ["doc_id"], "n long", lambda texts: {"n": [len(t) for t in texts]}, seen).count() == 8
    assert (tmp_path / "ended").read_text() == "xx"
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= common.BATCH_BYTES <= 4 << 20
