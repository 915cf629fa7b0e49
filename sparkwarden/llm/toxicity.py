"""Toxicity by a lexicon trie met with Levenshtein automata, and by the windows around what is found.

1. Lexicon. Words of a bounded sample of labelled documents (``SAMPLE`` of each label, by hash of the id) are counted by
   the distinct contexts they stand in, so that copies of one text count once. A word is a term if its share of toxic
   contexts cannot be chance among all words tried and most of its documents are toxic. Beginnings that many different
   words share are tested alike and become stems; a stem is as long as its evidence allows.
2. Matching. Terms and stems form one trie. The automaton reads a word against all terms at once: a state is the set of
   trie nodes that are in reach, each with the least number of edits (substitution, insertion, deletion) so far, and a
   node goes when no term below allows so many. States and steps are kept as they are met, so nearly all words end after
   a few dictionary look-ups. Terms of five letters allow one edit, of nine two, shorter ones and stems none. Words near
   a term that clean documents use (``FAMILIAR`` of them, by their contexts) are no misspelling.
3. Windows. What stands around a find says whether it is quoted: quotation marks that open before and close behind it,
   or a quoted line. Words of the window add evidence, as far as windows of toxic and of clean finds differ in them.
4. Score. Finds count by kind (term, stem, misspelt; plain or quoted) in a logistic model of few weights. They are pulled
   towards weights that take a quotation for little evidence, which labels can overrule.

Labels are read only from rows outside the held-out fifth. Text is the only input of a score. Scoring is a narrow pass.

Defined results: null and empty texts have no finds, and the score of a text without any. Rows that repeat are scored
alike, one row each. Null labels and null ids teach nothing; a null doc_id is not held out; of rows that share a
labelled doc_id the text with the least hash is learnt from. Ties of terms beyond ``TERMS`` go by the word. Long texts
are read whole, in blocks that end between words; windows reach over the ends of blocks. Without labels of both kinds
the lexicon is empty and all scores are equal. Extra columns are not looked at. Empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.llm.common import map_texts, table
from sparkwarden.session import discard, materialize

# Labelled rows of each label that are learnt from; the most terms, stems and familiar words that a model holds.
SAMPLE, TERMS, STEMS, FAMILIAR = 4_000, 4_096, 512, 20_000
THRESHOLD, PARTS, HELD_OUT = 0.5, 5, 0
# Least chance that a term passes by luck, least share of toxic contexts, words that must share a stem and its length.
LUCK, PURE, SHARERS, STEM = 0.01, 0.6, 3, (4, 10)
# Letters from which on a term allows one and two edits; characters on both sides of a find; text read at once.
EDITS, WINDOW, BLOCK = (5, 9), 80, 1 << 20
# Windows of clean finds without which the words around a find say nothing.
WINDOWS = 20

WORD = re.compile(r"\w+(?:[*@$]\w+)*")
KINDS = ("term", "stem", "misspelt")
# Weights of a text without finds, plain finds by kind, quoted finds by kind, and the words around them.
PRIOR = np.array([-3.0, 4.0, 4.0, 0.5, 0.5, 0.5, 0.0, 0.5])
PULL = np.array([0.01, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5])
_OPEN, _CLOSE = "“„«‹", "”“»›"
_REMEMBERED, _STATES = 100_000, 50_000


@dataclass(frozen=True)
class Model:
    terms: tuple[str, ...] = ()
    stems: tuple[str, ...] = ()
    familiar: frozenset[str] = frozenset()
    around: tuple[tuple[str, float], ...] = ()
    weights: tuple[float, ...] = tuple(PRIOR)


class Automaton:
    """All terms and stems at once. ``match`` says which is met: (kind, text of the trie), or None."""

    def __init__(self, terms: Iterable[str], stems: Iterable[str]) -> None:
        self.child: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.allows = [0]  # edits that some term below allows
        for text, is_stem in [(t, False) for t in terms] + [(s, True) for s in stems]:
            self._insert(text, is_stem)
        self._clear()

    def _insert(self, text: str, is_stem: bool) -> None:
        edits = 0 if is_stem else allowed(text)
        node = 0
        self.allows[0] = max(self.allows[0], edits)
        for letter in text:
            if letter not in self.child[node]:
                self.child[node][letter] = len(self.child)
                self.child.append({})
                self.term.append(None)
                self.stem.append(None)
                self.allows.append(0)
            node = self.child[node][letter]
            self.allows[node] = max(self.allows[node], edits)
        (self.stem if is_stem else self.term)[node] = text

    def _clear(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.step: list[dict[str, int]] = []
        self.ends: list[tuple[str, str] | None] = []
        self.begins: list[tuple[str, str] | None] = []
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, reach: dict[int, int]) -> dict[int, int]:
        """With the nodes that leaving out letters of a term leads to."""
        todo = list(reach)
        while todo:
            node = todo.pop()
            edits = reach[node] + 1
            for after in self.child[node].values():
                if edits <= self.allows[after] and edits < reach.get(after, 99):
                    reach[after] = edits
                    todo.append(after)
        return reach

    def _state(self, reach: dict[int, int]) -> int:
        key = frozenset(reach.items())
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(reach)
            self.step.append({})
            met = sorted((edits, self.term[n]) for n, edits in reach.items() if self.term[n] and edits <= allowed(self.term[n]))
            self.ends.append((KINDS[2 if met[0][0] else 0], met[0][1]) if met else None)
            stem = [self.stem[n] for n, edits in reach.items() if self.stem[n] and not edits]
            self.begins.append((KINDS[1], stem[0]) if stem else None)
        return self.number[key]

    def _next(self, state: int, letter: str) -> int:
        """The state after a letter, or -1."""
        reach: dict[int, int] = {}
        for node, edits in self.sets[state].items():
            if edits < self.allows[node]:
                reach[node] = min(edits + 1, reach.get(node, 99))
            for sign, after in self.child[node].items():
                now = edits + (sign != letter)
                if now <= self.allows[after] and now < reach.get(after, 99):
                    reach[after] = now
        out = self._state(self._closed(reach)) if reach else -1
        self.step[state][letter] = out
        return out

    def match(self, word: str) -> tuple[str, str] | None:
        if len(self.sets) > _STATES:
            self._clear()
        state, step = self.start, self.step
        for letter in word:
            state = step[state].get(letter, -2) if state >= 0 else -1
            if state == -2:
                state = self._after(word)
                return state
            if state < 0:
                return None
            if self.begins[state]:
                return self.begins[state]
        return self.ends[state]

    def _after(self, word: str) -> tuple[str, str] | None:
        """As ``match``, adding the steps that are missing."""
        state = self.start
        for letter in word:
            known = self.step[state].get(letter)
            state = self._next(state, letter) if known is None else known
            if state < 0:
                return None
            if self.begins[state]:
                return self.begins[state]
        return self.ends[state]


def allowed(term: str) -> int:
    """Edits that a term allows."""
    return sum(len(term) >= n for n in EDITS)


class Finder:
    """Finds in texts, and the numbers that a score is made of."""

    def __init__(self, model: Model) -> None:
        self.automaton = Automaton(model.terms, model.stems)
        self.familiar = model.familiar
        self.around = dict(model.around)
        self.known: dict[str, tuple[str, str] | None] = {}
        self.empty = not model.terms and not model.stems

    def of(self, word: str) -> tuple[str, str] | None:
        met = self.automaton.match(word)
        if met and met[0] == KINDS[2] and word in self.familiar:
            met = None
        if len(word) <= 40:
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            self.known[word] = met
        return met

    def finds(self, text: str) -> list[tuple[int, int, str, str]]:
        """Start, end, kind and term of each find in a text in lower case."""
        out: list[tuple[int, int, str, str]] = []
        if self.empty:
            return out
        at = 0
        while at < len(text):
            end = _cut(text, at)
            block = text[at:end]
            known, of = self.known, self.of
            words = WORD.findall(block)
            if any([known[w] if w in known else of(w) for w in words]):
                for m in WORD.finditer(block):
                    met = known[m[0]] if m[0] in known else of(m[0])
                    if met:
                        out.append((at + m.start(), at + m.end(), *met))
            at = end
        return out

    def numbers(self, text: str | None) -> list[float]:
        """One, plain finds by kind, quoted finds by kind (logarithms of counts), and the words around finds."""
        text = lowered(text)
        counts = [[0, 0, 0], [0, 0, 0]]
        beside = 0.0
        found = self.finds(text)
        for start, end, kind, _ in found:
            counts[quoted(text, start, end)][KINDS.index(kind)] += 1
            if self.around:
                beside += sum(self.around.get(w, 0.0) for w in window(text, start, end))
        beside = max(-3.0, min(3.0, beside / len(found))) if found else 0.0
        return [1.0, *(math.log1p(n) for side in counts for n in side), beside]


def lowered(text: str | None) -> str:
    """In lower case, letter by letter where that keeps places."""
    text = text or ""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _cut(text: str, at: int) -> int:
    """Where a block ends that starts at ``at``: behind a character that no word holds."""
    end = min(at + BLOCK, len(text))
    while end < len(text) and (text[end - 1].isalnum() or text[end - 1] in "_*@$"):
        end += 1
    return end


def quoted(text: str, start: int, end: int) -> bool:
    """Whether marks open before and close behind a find, in its line and window, or its line is a quoted one."""
    before, behind = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    line = before.rfind("\n") + 1
    if before[line:].lstrip().startswith(">") and (line or start <= WINDOW):
        return True
    before, behind = before[line:], behind.partition("\n")[0]
    if before.count('"') % 2 and '"' in behind:
        return True
    opened = max(map(before.rfind, _OPEN))
    return opened > max(before.rfind("”"), before.rfind("»"), before.rfind("›"), -1) and any(c in behind for c in _CLOSE)


def window(text: str, start: int, end: int) -> set[str]:
    """Whole words on both sides of a find."""
    before, behind = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    before = before if start <= WINDOW else before.partition(" ")[2]
    behind = behind if end + WINDOW >= len(text) else behind.rpartition(" ")[0]
    return {*WORD.findall(before), *WORD.findall(behind)}


@lru_cache(maxsize=2)
def finder(model: Model) -> Finder:
    """One automaton for all tasks of a worker."""
    return Finder(model)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % PARTS == HELD_OUT, F.lit(False))


def _examples(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, toxic, text`` of at most ``sample`` rows of each label, and how many rows have it."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic").distinct()
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    some = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for t in (1, 0)]
    picked = materialize(some[0].union(some[1]), "sample")
    named = docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi")
    one = named.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return materialize(one.join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text"), "examples"), counts


def _contexts(texts: list[str | None]) -> dict:
    """Each word of a text with a hash of its neighbours."""
    seen = []
    for text in texts:
        words = WORD.findall(lowered(text))
        beside = zip(["", *words], words, [*words[1:], ""], strict=False)
        seen.append([{"word": w, "context": hash_of(f"{a} {b}")} for a, w, b in set(beside) if len(w) <= 40])
    return {"words": seen}


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text) >> 1


def _unlikely(toxic: Column, clean: Column, share: float, tried: int) -> Column:
    """Whether ``toxic`` contexts of all are too many for chance, where ``share`` is usual, in ``tried`` tests."""
    all_of = toxic + clean
    log = lambda n, usual: F.when(n > 0, n * F.log(n / (all_of * usual))).otherwise(0.0)
    return (toxic > all_of * share) & (log(toxic, share) + log(clean, 1 - share) > math.log(max(tried, 1) / LUCK))


def lexicon(examples: DataFrame, counts: dict[int, int]) -> tuple[list[str], list[str], DataFrame]:
    """Terms, stems, and the words with their numbers of ``toxic`` and ``clean`` contexts."""
    words = map_texts(examples, "text", ["toxic"], "words array<struct<word:string,context:long>>", _contexts)
    words = words.select("toxic", F.inline("words")).distinct()
    usage = materialize(words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")), "words")
    toxic, clean, tried = usage.agg(F.sum("toxic"), F.sum("clean"), F.count("*")).first()
    if not toxic or not clean:
        return [], [], usage
    share = toxic / (toxic + clean)
    of = {r[0]: r[1] for r in examples.groupBy("toxic").count().collect()}
    # Clean documents are sampled more thinly than toxic ones.
    clean_of_all = F.col("clean") * (counts[0] / of[0]) / (counts[1] / of[1])
    pure = F.col("toxic") >= PURE * (F.col("toxic") + clean_of_all)
    pick = pure & _unlikely(F.col("toxic"), F.col("clean"), share, tried)
    terms = [r.word for r in usage.where(pick).orderBy(F.desc("toxic"), "word").limit(TERMS).collect()]
    first, last = STEM
    heads = usage.where(F.length("word") >= first).select("toxic", "clean", "word", F.explode(F.sequence(F.lit(first), F.least(F.length("word"), F.lit(last)))).alias("n"))
    heads = heads.groupBy(F.substring("word", F.lit(1), F.col("n")).alias("head")).agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count(F.when(F.col("toxic") > 0, 1)).alias("sharers")
    )
    heads = heads.where(pick & (F.col("sharers") >= SHARERS)).orderBy(F.desc("toxic"), "head").limit(16 * STEMS)
    stems = _stems({r.head: r.toxic for r in heads.collect()})[:STEMS]
    starts = tuple(stems)
    return [t for t in terms if not t.startswith(starts)] if starts else terms, stems, usage


def _stems(heads: dict[str, int]) -> list[str]:
    """Of beginnings that continue each other, the longest that keeps nine tenths of the evidence of the first."""
    out = []
    for head in sorted(heads, key=len):
        if any(head[:n] in heads for n in range(1, len(head))):
            continue
        kept = max((x for x in heads if x.startswith(head) and heads[x] >= 0.9 * heads[head]), key=len)
        out.append(kept)
    return sorted(out, key=lambda x: (-heads[x], x))


def _familiar(usage: DataFrame, model: Model) -> frozenset[str]:
    """Words that clean documents use although a term is near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = finder(model).automaton
        for batch in batches:
            near = [(automaton.match(w) or "")[:1] == (KINDS[2],) for w in batch.column(0).to_pylist()]
            yield batch.filter(pa.array(near, pa.bool_()))

    rows = usage.where("clean > 0").select("word", "clean").mapInArrow(run, "word string, clean long")
    return frozenset(r.word for r in rows.orderBy(F.desc("clean"), "word").limit(FAMILIAR).collect())


def _around(examples: DataFrame, model: Model) -> tuple[tuple[str, float], ...]:
    """Words that stand beside toxic or clean finds much more often, with bounded logarithms of their shares."""

    def step(texts: list[str | None]) -> dict:
        out = []
        for text in map(lowered, texts):
            out.append([sorted(window(text, s, e)) for s, e, _, _ in finder(model).finds(text)])
        return {"windows": out}

    windows = map_texts(examples, "text", ["toxic"], "windows array<array<string>>", step)
    windows = materialize(windows.select("toxic", F.explode("windows").alias("words")), "windows")
    all_of = {r[0]: r[1] for r in windows.groupBy("toxic").count().collect()}
    found: tuple = ()
    if min(all_of.get(0, 0), all_of.get(1, 0)) >= WINDOWS:
        rows = windows.select("toxic", F.explode("words").alias("word")).groupBy("word")
        rows = rows.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        log = F.log((F.col("t") + 1) / (all_of[1] + 2)) - F.log((F.col("c") + 1) / (all_of[0] + 2))
        rows = rows.where("t + c >= 5").select("word", log.alias("log")).where(F.abs("log") > 1)
        rows = rows.orderBy(F.desc(F.abs("log")), "word").limit(TERMS).collect()
        found = tuple((r.word, max(-2.0, min(2.0, r.log))) for r in rows)
    discard(windows)
    return found


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic model that are pulled towards ``PRIOR``, by Newton's method."""
    w = PRIOR.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (weight * (y - p)) - PULL * (w - PRIOR)
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(PULL)
        step = np.linalg.solve(bend, slope)
        w = w + step * min(1.0, 3 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    examples, counts = _examples(docs, labels, sample)
    if len(counts) < 2:
        return Model()
    # Words are familiar by one half of the clean examples; the other half tells what near words are worth.
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))
    terms, stems, usage = lexicon(examples, counts)
    model = Model(tuple(terms), tuple(stems))
    if terms or stems:
        seen = map_texts(examples.where((F.col("toxic") == 0) & (half == 0)), "text", ["toxic"], "words array<struct<word:string,context:long>>", _contexts)
        seen = seen.select(F.inline("words")).groupBy("word").agg(F.count("*").alias("clean"))
        model = Model(model.terms, model.stems, _familiar(seen, model))
        model = Model(model.terms, model.stems, model.familiar, _around(examples.where((F.col("toxic") == 1) | (half == 0)), model))
    made = map_texts(examples.where((F.col("toxic") == 1) | (half == 1)), "text", ["doc_id", "toxic"], "f array<double>", lambda texts: {"f": [finder(model).numbers(t) for t in texts]})
    rows = made.orderBy("doc_id", "toxic", "f").collect()  # at most ``sample`` of each label
    discard(examples, usage)
    y = np.array([r.toxic for r in rows], dtype=float)
    of = {t: max(int((y == t).sum()), 1) for t in (0, 1)}
    weight = np.where(y == 1, counts[1] / of[1], counts[0] / of[0])
    weight = weight * (len(rows) / max(weight.sum(), 1e-12))
    x = np.array([r.f for r in rows]).reshape(-1, len(PRIOR))
    return Model(model.terms, model.stems, model.familiar, model.around, tuple(fit(x, y, weight)))


def score(docs: DataFrame, keep: list[str], model: Model, text: str = "text") -> DataFrame:
    """``keep`` and ``score``."""

    def step(texts: list[str | None]) -> dict:
        numbers = np.array([finder(model).numbers(t) for t in texts]).reshape(-1, len(PRIOR))
        return {"score": 1 / (1 + np.exp(-np.clip(numbers @ np.array(model.weights), -500, 500)))}

    return map_texts(docs, text, keep, "score double", step)


def finds(docs: DataFrame, keep: list[str], model: Model, text: str = "text") -> DataFrame:
    """``keep`` and ``finds``: start and end in characters, kind, term, and whether it is quoted."""

    def step(texts: list[str | None]) -> dict:
        out = []
        for low in map(lowered, texts):
            found = finder(model).finds(low)
            out.append([{"start": s, "end": e, "kind": k, "term": t, "quoted": quoted(low, s, e)} for s, e, k, t in found])
        return {"finds": out}

    return map_texts(docs, text, keep, "finds array<struct<start:int,end:int,kind:string,term:string,quoted:boolean>>", step)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, ["doc_id"], learn(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
