"""Token counts by batch encoding in Arrow functions that return lengths only.

Texts are taken in batches of bounded bytes and cut at safe boundaries: places that no piece of the vocabulary spans,
so that the pieces on both sides cannot merge and the counts add up to the count of the whole text. Equal parts of a
batch are encoded once. A model without safe boundaries gets its texts whole.

Defined results: a null or empty text has no bytes and no tokens. Repeated rows are counted alike, one row each. Any
length is counted whole. Extra columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
import sys

from pyspark.sql import DataFrame, SparkSession

from sparkwarden.llm.common import map_texts, table

TOKENIZER = "piece_bpe_32k.model"
# Bytes of parts and counts that a worker remembers before it starts again; longer parts (in characters) are not remembered.
REMEMBERED, LONGEST = 96 << 20, 200
SPACE = "▁"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def processor(path: str, marked: bool = False):
    """The library's processor; ``marked``: for parts that carry their space marks already."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    if not marked:
        return sentencepiece.SentencePieceProcessor(model_file=path)
    spec = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        spec.ParseFromString(file.read())
    spec.normalizer_spec.add_dummy_prefix = False
    return sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())


@functools.cache
def splits_before_space(path: str) -> bool:
    """Whether a space mark behind another character is a safe boundary.

    It is where the normaliser only marks spaces, and no piece holds a mark behind another character.
    """
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        spec.ParseFromString(file.read())
    rules = spec.normalizer_spec
    plain = rules.add_dummy_prefix and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
    return plain and not any(re.search(f"[^{SPACE}]{SPACE}", piece.piece) for piece in spec.pieces)


_PART = re.compile(f"{SPACE}+[^{SPACE}]*")


def parts_of(text: str | None, path: str) -> list[str]:
    """The text as the normaliser leaves it, cut at safe boundaries; the whole text for a model that has none."""
    if not text:
        return []
    return _PART.findall(SPACE + text.replace(" ", SPACE)) if splits_before_space(path) else [text]


class Remembered(dict):
    """Results of parts, and the bytes that they take."""

    held = 0

    def start(self, most: int) -> None:
        """Before a batch: starts again above ``most`` bytes."""
        if self.held > most:
            self.clear()
            self.held = 0

    def end(self, new: list[str]) -> None:
        """After a batch that added ``new`` parts: forgets the long ones, counts the others."""
        for part in new:
            if len(part) > LONGEST:
                del self[part]
            else:
                # An entry of the table takes some hundred bytes besides.
                self.held += sys.getsizeof(part) + sys.getsizeof(self[part]) + 100


_COUNTS: dict[str, Remembered] = {}


def count_batch(texts: list[str | None], path: str) -> list[int]:
    known = _COUNTS.setdefault(path, Remembered())
    known.start(REMEMBERED)
    cut = [parts_of(t, path) for t in texts]
    new = list({p for parts in cut for p in parts if p not in known})
    encoder = processor(path, splits_before_space(path))
    for start in range(0, len(new), 4096):
        some = new[start : start + 4096]
        known.update(zip(some, map(len, encoder.encode(some, num_threads=1)), strict=True))
    get = known.__getitem__
    counts = [sum(map(get, parts)) for parts in cut]
    known.end(new)
    return counts


def count_tokens(docs: DataFrame, keep: list[str], text: str = "text", tokenizer: str = TOKENIZER, limit: int = 4096) -> DataFrame:
    """``keep``, UTF-8 bytes, tokens of a SentencePiece model without begin or end, and whether they pass ``limit``."""

    def step(texts: list[str | None]) -> dict:
        counts = count_batch(texts, tokenizer_path(tokenizer))
        return {
            "n_bytes": [len(t.encode()) if t else 0 for t in texts],
            "n_tokens": counts,
            "over_limit": [n > limit for n in counts],
        }

    return map_texts(docs, text, keep, "n_bytes long, n_tokens long, over_limit boolean", step)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), ["doc_id"])
