import random
import zlib

import numpy as np
import pytest

from sparkwarden.llm import toxicity as X

DATA = "/root/testdata/sf0.01"
MODEL = X.Model(("moron", "idiot", "disgusting", "rat", "worthless"), ("lowei",), frozenset({"oron"}))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(word, terms, stems):
    stem = next((s for s in sorted(stems, key=len) if word.startswith(s)), None)
    if stem:
        return "stem", stem
    near = sorted((distance(word, t), t) for t in terms if distance(word, t) <= X.allowed(t))
    return (("misspelt" if near[0][0] else "term"), near[0][1]) if near else None


def test_automaton_equals_edit_distances():
    rng = random.Random(4)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(3, 12))) for _ in range(60)})
    stems = ["abcab", "cccc"]
    terms = [t for t in terms if not t.startswith(tuple(stems))]
    automaton = X.Automaton(terms, stems)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 13))) for _ in range(3000)]
    for t in terms:
        i = rng.randrange(len(t))
        words += [t, t[:i] + t[i + 1 :], t[:i] + "d" + t[i:], t[:i] + "d" + t[i + 1 :], "d" + t + "d"]
    for word in words * 2:
        assert automaton.match(word) == brute(word, terms, stems), word


def test_few_states_are_kept(monkeypatch):
    monkeypatch.setattr(X, "_STATES", 5)
    automaton = X.Automaton(["moron", "worthless"], [])
    assert [automaton.match(w) for w in ("moran", "wortless", "cat", "moron")] == [("misspelt", "moron"), ("misspelt", "worthless"), None, ("term", "moron")]


@pytest.mark.parametrize(
    "text, want",
    [
        ("You MORON!", [("term", False)]), ("a mor0n, an oron", [("misspelt", False)]), ("loweixyz went", [("stem", False)]),
        ('he said "you moron" to me', [("term", True)]), ("« idiot »", [("term", True)]), ("“an idiot” and moron", [("term", True), ("term", False)]),
        ('"fine" moron "fine"', [("term", False)]), ("> you idiot", [("term", True)]), ("x\n> you idiot\nidiot", [("term", True), ("term", False)]),
        ("id*ot rats rat", [("misspelt", False), ("term", False)]), ("dsgustng wrthles", [("misspelt", False), ("misspelt", False)]), ("", []), (None, []),
    ],
)
def test_finds_and_quotations(text, want):
    low = X.lowered(text)
    assert [(k, X.quoted(low, s, e)) for s, e, k, _ in X.Finder(MODEL).finds(low)] == want


def test_blocks_change_nothing(monkeypatch):
    rng = random.Random(9)
    text = " ".join(rng.choice(["moron", "fine", "'idiot'", "x" * 70, "disgustin", "\n"]) for _ in range(400))
    whole = X.Finder(MODEL).finds(text), X.Finder(MODEL).numbers(text)
    for size in (1, 7, 100):
        monkeypatch.setattr(X, "BLOCK", size)
        assert (X.Finder(MODEL).finds(text), X.Finder(MODEL).numbers(text)) == whole
    assert X.lowered("İİ moron") == "İİ moron" and len(whole[0]) > 100


def test_quoted_finds_count_less_until_labels_say_otherwise(spark):
    docs = spark.createDataFrame([(1, "you moron"), (2, 'the word "moron" is rude'), (3, "fine"), (4, None)], "doc_id long, text string")
    plain, cited, none, null = (r.score for r in X.score(docs, ["doc_id"], MODEL).orderBy("doc_id").collect())
    assert plain > cited > none == null and plain > X.THRESHOLD * 0.8 and cited < X.THRESHOLD
    x = np.array([X.Finder(MODEL).numbers(t) for t in ['a "moron" here', "fine"] * 50])
    taught = X.fit(x, np.array([1.0, 0.0] * 50), np.ones(100))
    assert taught[4] > 2 > X.PRIOR[4]


def test_held_out_accuracy(spark):
    scored = X.op13_toxicity(spark, DATA)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    docs = scored.collect()
    assert len(docs) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in docs)
    rows = scored.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    unseen = [r for r in rows if r.held_out]
    toxic, clean = ([r.score for r in unseen if r.toxic == t] for t in (1, 0))
    assert np.mean(np.array(toxic)[:, None] > np.array(clean)[None, :]) > 0.9
    assert np.mean([r.predicted == r.toxic for r in unseen]) > 0.95


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", X.F.when(X.held_out(labels["doc_id"]), 1 - X.F.col("toxic")).otherwise(X.F.col("toxic")))
    assert X.learn(docs, labels) == X.learn(docs, turned)


def test_copies_are_no_evidence_and_variants_become_stems(spark):
    rng = random.Random(3)
    made = lambda: " ".join("".join(rng.choice("aeiou") + rng.choice("rstln") for _ in range(3)) for _ in range(40))
    ids = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5]
    copied = made() + " repeated"
    rows = [(i, made() + (f" bork{chr(97 + i % 20)}{i % 7} zwark " if i % 2 else " ") + made()) for i in ids[:400]]
    rows += [(i, copied) for i in ids[400:600] if i % 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = X.learn(docs, labels)
    assert "zwark" in model.terms and "bork" in model.stems and "repeated" not in model.terms


def test_odd_rows(spark):
    rows = [(1, "you moron", 0.5, "a"), (1, "you moron", 0.5, "a"), (None, "idiot", None, None), (2, None, 1.0, "b"), (3, "", 1.0, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, word string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, toxic int")
    assert X.learn(docs, labels) == X.Model() == X.learn(docs.limit(0), labels)
    assert X.learn(docs, labels.limit(0)) == X.Model()
    both = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 1)], "doc_id long, toxic int")
    for model in (X.Model(), MODEL, X.learn(docs, both)):
        found = X.score(docs, ["doc_id"], model).collect()
        assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert X.score(docs.limit(0), ["doc_id"], MODEL).count() == 0
    spans = {r.doc_id: r.finds for r in X.finds(docs, ["doc_id"], MODEL).collect()}
    assert [tuple(s) for s in spans[1]] == [(4, 9, "term", "moron", False)] and spans[2] == []
