"""SentencePiece encoding and decoding by suffix-array matching.

The distinct parts of a batch of texts (cut at safe boundaries) are joined to one text, whose suffix array is built by
doubling up to the longest piece. Every piece of the vocabulary is looked up in it by binary search, all pieces at once;
its range of suffixes is its occurrences. These are the edges of the segmentation graph. Sorted by where they end, they
are relaxed from left to right in all parts together.

For a merge (BPE) model a prefix of a text has one segmentation, and it ends in one piece: the one that the model would
not merge, or split differently, next to the piece before it. So an edge is relaxed if the pair of the piece before and
its own stays as it is under the model's merges, which is worked out once for each pair. The ids equal the library's.

Defined results: null and empty texts have no ids. A character that is no piece becomes its UTF-8 bytes; a space and
``▁`` are the same to the model, so the round trip gives a space for both. Repeated rows are encoded alike. Texts of any
length are encoded whole. Extra columns are not looked at. Empty tables give empty results.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from sparkwarden.llm.common import map_texts, table
from sparkwarden.llm.token_counts import SPACE, TOKENIZER, Remembered, parts_of, tokenizer_path

# Characters of one suffix array; bytes of parts that a task, and pairs that a worker remembers.
TEXT, REMEMBERED, REMEMBERED_PAIRS = 400_000, 96 << 20, 2_000_000
_START, _NONE = -1 << 30, -1 << 31


class Pieces:
    """The vocabulary of a merge model that marks spaces and falls back to bytes."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = proto.ModelProto.SentencePiece
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("a merge (BPE) model with byte fallback is needed")
        self.text = [p.piece for p in model.pieces]
        self.kind_of_byte = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte = np.array([self.kind_of_byte[f"<0x{b:02X}>"] for b in range(256)])
        normal = [i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
        self.score = {self.text[i]: model.pieces[i].score for i in normal}
        self.id = {self.text[i]: i for i in normal}
        # A piece that the merges never make is no edge.
        made = [i for i in normal if self.merged(self.text[i]) == [self.text[i]]]
        self.ids = np.array(made)
        self.length = np.array([len(self.text[i]) for i in made])
        self.depth = int(self.length.max())
        self.codes = np.zeros((len(made), self.depth), dtype=np.int64)
        for row, i in enumerate(made):
            self.codes[row, : len(self.text[i])] = [ord(c) for c in self.text[i]]
        self.single = np.sort(self.codes[self.length == 1, 0])
        self.size_of = np.ones(len(self.text), dtype=np.int64)
        self.size_of[self.ids] = self.length
        self.pairs, self.pair_stays = np.array([-1]), np.array([False])
        self.known = Remembered()
        self.bytes_of = [bytes([int(p[3:5], 16)]) if p in self.kind_of_byte else p.encode() for p in self.text]

    def merged(self, text: str) -> list[str]:
        """The model's merges on a short text: the best pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stay(self, pairs: np.ndarray) -> np.ndarray:
        """Whether neighbouring pieces, two packed in one number, are left as they are."""
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        new = np.unique(pairs[self.pairs[at] != pairs])
        if len(new):
            if len(self.pairs) > REMEMBERED_PAIRS:
                self.pairs, self.pair_stays = np.array([-1]), np.array([False])
                return self.stay(pairs)
            found = [self._stays(p) for p in new.tolist()]
            place = np.searchsorted(self.pairs, new)
            self.pairs, self.pair_stays = np.insert(self.pairs, place, new), np.insert(self.pair_stays, place, found)
            at = np.searchsorted(self.pairs, pairs)
        return self.pair_stays[at]

    def _stays(self, pair: int) -> bool:
        x, y = self.text[pair >> 32], self.text[pair & 0xFFFFFFFF]
        return self.merged(x + y) == [x, y]


@functools.cache
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` codes or more; codes take 21 bits, zeros end a part."""
    n = len(codes)
    ahead = lambda x, k: np.concatenate([x[k:], np.zeros(min(k, n), dtype=np.int64)])
    key = codes << 42 | ahead(codes, 1) << 21 | ahead(codes, 2)
    reach = 3
    while True:
        order = np.argsort(key)
        if reach >= depth:
            return order
        ranked = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[1], 1 + np.cumsum(ranked[1:] != ranked[:-1])])
        key = rank << 32 | ahead(rank, reach)
        reach *= 2


def occurrences(codes: np.ndarray, order: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ranges [low, high) of suffixes that start with each piece: a binary search for all pieces at once, by place."""
    padded = np.concatenate([codes, np.zeros(pieces.depth, dtype=np.int64)])
    low = np.zeros(len(pieces.ids), dtype=np.int64)
    high = np.full(len(pieces.ids), len(codes), dtype=np.int64)
    for d in range(pieces.depth):
        rows = np.flatnonzero((pieces.length > d) & (low < high))
        if not len(rows):
            break
        code = pieces.codes[rows, d]
        bounds = []
        for least in (code, code + 1):
            a, b = low[rows].copy(), high[rows].copy()
            while True:
                open_ = np.flatnonzero(a < b)
                if not len(open_):
                    break
                middle = (a[open_] + b[open_]) >> 1
                below = padded[order[middle] + d] < least[open_]
                a[open_[below]] = middle[below] + 1
                b[open_[~below]] = middle[~below]
            bounds.append(a)
        low[rows], high[rows] = bounds
    return low, np.maximum(low, high)


def _edges(codes: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and piece of every occurrence; characters that are no piece are edges below zero."""
    order = suffix_array(codes, pieces.depth)
    low, high = occurrences(codes, order, pieces)
    count = high - low
    spots = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
    strange = np.flatnonzero((codes > 0) & ~np.isin(codes, pieces.single))
    # Edges are many: 32 bits for each of their numbers, which all fit, halve what a task holds.
    start = np.concatenate([order.astype(np.int32)[spots], strange.astype(np.int32)])
    length = np.concatenate([np.repeat(pieces.length.astype(np.int32), count), np.ones(len(strange), dtype=np.int32)])
    return start, length, np.concatenate([np.repeat(pieces.ids.astype(np.int32), count), -codes[strange].astype(np.int32)])


def relax(codes: np.ndarray, begin: np.ndarray, pieces: Pieces) -> np.ndarray:
    """For every place between characters, the piece that the segmentation of its part up to there ends in."""
    start, length, piece = _edges(codes, pieces)
    end = start + length
    depth = end - np.repeat(begin.astype(np.int32), np.diff(np.append(begin, len(codes))))[start]
    by = np.argsort(depth, kind="stable")
    start, end, piece, depth = start[by], end[by], piece[by], depth[by]
    last = np.full(len(codes) + 1, _NONE, dtype=np.int64)
    last[begin] = _START
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(depth)) + 1, [len(depth)]])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        before, own = last[start[a:b]], piece[a:b]
        ok = before != _NONE
        # The first piece of a part, and strange characters, merge with nobody.
        ask = np.flatnonzero(ok & (before >= 0) & (own >= 0))
        if len(ask):
            ok[ask] = pieces.stay(before[ask] << 32 | own[ask])
        last[end[a:b][ok]] = own[ok]
    return last


def _encode_parts(parts: list[str], pieces: Pieces) -> list[bytes]:
    """Ids of each part, as bytes of 32-bit numbers."""
    codes = np.frombuffer("\0".join([*parts, ""]).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    size = np.array([len(p) for p in parts])
    end = np.cumsum(size + 1) - 1
    begin = end - size
    # A zero inside a part would end it; it is no piece, so any other code that is no piece will do.
    inside = np.ones(len(codes), dtype=bool)
    inside[end] = False
    codes[inside & (codes == 0)] = 0x1FFFFF
    last = relax(codes, begin, pieces)
    owners, steps, tokens = [], [], []
    at, who, step = end.copy(), np.arange(len(parts)), 0
    while len(who):
        token = last[at]
        owners.append(who)
        steps.append(np.full(len(who), step))
        tokens.append(token)
        at = at - np.where(token >= 0, pieces.size_of[np.maximum(token, 0)], 1)
        going = at > begin[who]
        at, who, step = at[going], who[going], step + 1
    owner, token = np.concatenate(owners), np.concatenate(tokens)
    by = np.lexsort((-np.concatenate(steps), owner))
    owner, token = owner[by], token[by]
    wide = np.flatnonzero(token < 0)
    if len(wide):
        spelled = [_bytes(-t, pieces) for t in token[wide].tolist()]
        times = np.ones(len(token), dtype=np.int64)
        times[wide] = [len(s) for s in spelled]
        place = np.cumsum(times) - times
        owner, token = np.repeat(owner, times), np.repeat(token, times)
        for i, s in zip(place[wide].tolist(), spelled, strict=True):
            token[i : i + len(s)] = s
    data = token.astype("<i4").tobytes()
    cut = np.searchsorted(owner, np.arange(len(parts) + 1)) * 4
    return [data[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def _bytes(code: int, pieces: Pieces) -> list[int]:
    text = "\0" if code == 0x1FFFFF else chr(code)
    return [int(pieces.byte[b]) for b in text.encode("utf-8", "surrogatepass")]


def encode_batch(texts: list[str | None], path: str) -> list[np.ndarray]:
    """Ids of each text."""
    pieces = pieces_of(path)
    known = pieces.known
    known.start(REMEMBERED)
    # Equal parts of a batch are one object: of all others only the places are held.
    own: dict[str, str] = {}
    cut = [list(map(own.setdefault, parts, parts)) for parts in (parts_of(t, path) for t in texts)]
    new = [p for p in own if p not in known]
    at = 0
    while at < len(new):
        size, end = 0, at
        while end < len(new) and (end == at or size + len(new[end]) < TEXT):
            size += len(new[end]) + 1
            end += 1
        known.update(zip(new[at:end], _encode_parts(new[at:end], pieces), strict=True))
        at = end
    get = known.__getitem__
    ids = [np.frombuffer(b"".join(map(get, parts)), dtype="<i4") for parts in cut]
    known.end(new)
    return ids


def forget(path: str) -> None:
    """Drops the parts that a worker remembers."""
    pieces_of(path).known.start(-1)


def decode(ids: np.ndarray, path: str) -> str:
    """The text of some ids: pieces joined, bytes put together, marks made spaces, the leading one dropped."""
    spelled = pieces_of(path).bytes_of
    text = b"".join([spelled[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, keep: list[str], text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``keep`` and ``ids``."""
    return map_texts(docs, text, keep, "ids array<int>", lambda texts: {"ids": encode_batch(texts, tokenizer_path(tokenizer))}, lambda: forget(tokenizer_path(tokenizer)))


def decoded(rows: DataFrame, keep: list[str], ids: str = "ids", tokenizer: str = TOKENIZER) -> DataFrame:
    """``keep`` and ``text`` of rows with ids; null ids are an empty text."""
    from pyspark.sql import functions as F

    # Ids travel as text, so that batches are balanced by bytes in the same way.
    spelled = rows.select(*keep, F.concat_ws(",", F.col(ids).cast("array<string>")).alias("__ids"))

    def step(texts: list[str | None]) -> dict:
        path = tokenizer_path(tokenizer)
        return {"text": [decode(np.array(t.split(","), dtype=np.int64), path) if t else "" for t in texts]}

    return map_texts(spelled, "__ids", keep, "text string", step)


def coded(docs: DataFrame, keep: list[str], text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``keep``, the ids, their number and digest (as little-endian 32-bit numbers), and whether they decode to the text."""

    def step(texts: list[str | None]) -> dict:
        path = tokenizer_path(tokenizer)
        every = encode_batch(texts, path)
        return {
            "n_tokens": [len(ids) for ids in every],
            "ids_sha256": [hashlib.sha256(ids.tobytes()).hexdigest() for ids in every],
            "round_trip": [decode(ids, path) == (t or "").replace(SPACE, " ") for ids, t in zip(every, texts, strict=True)],
            "ids": every,
        }

    return map_texts(docs, text, keep, "n_tokens long, ids_sha256 string, round_trip boolean, ids array<int>", step, lambda: forget(tokenizer_path(tokenizer)))


def op9_piece_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(table(spark, sf_dir, "documents"), ["doc_id"])
