"""Text to unit vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[list[str]], np.ndarray]


class HashingEmbedder:
    """Hashed word counts scaled to length one. Runs in the JVM and needs no model file."""

    def __init__(self, dim: int = 256):
        self.dim = dim

    def embed(self, df: DataFrame, text: str, out: str = "vector") -> DataFrame:
        words = RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}_./%-]+")
        counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=self.dim)
        unit = Normalizer(inputCol="_counts", outputCol="_unit")
        staged = unit.transform(counts.transform(words.transform(df.fillna("", [text]))))
        vector = vector_to_array("_unit", "float32")
        return staged.withColumn(out, vector).drop("_words", "_counts", "_unit")


class ModelEmbedder:
    """Vectors from a sentence model, loaded once per Python worker by ``load``.

    Each distinct text is encoded once and joined back by the text itself.
    """

    def __init__(self, load: Callable[[], Encoder], dim: int, batch_size: int = 256):
        self.load, self.dim, self.batch_size = load, dim, batch_size

    @classmethod
    def sentence_transformer(cls, name: str, dim: int = 768, device: str | None = None) -> ModelEmbedder:
        """The named public sentence model; fails at once where the library is missing."""
        try:
            import sentence_transformers  # noqa: F401
        except ImportError as e:
            raise RuntimeError("sentence_transformers is not installed; use HashingEmbedder or your own model") from e

        def load() -> Encoder:
            from sentence_transformers import SentenceTransformer

            return SentenceTransformer(name, device=device).encode

        return cls(load, dim)

    def embed(self, df: DataFrame, text: str, out: str = "vector") -> DataFrame:
        load, dim, step = self.load, self.dim, self.batch_size

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = load()
            for batch in batches:
                texts = batch.column(0)
                for start in range(0, len(texts), step):
                    part = texts.slice(start, step)
                    vectors = unit_rows(np.asarray(model(part.to_pylist()), dtype=np.float32))
                    if vectors.shape != (len(part), dim):
                        raise ValueError(f"model gave {vectors.shape}, expected {(len(part), dim)}")
                    yield pa.RecordBatch.from_arrays([part, list_array(vectors.astype(np.float32))], names=[text, out])

        distinct = df.select(F.coalesce(F.col(text), F.lit("")).alias(text)).distinct()
        encoded = distinct.mapInArrow(encode, f"`{text}` string, `{out}` array<float>")
        return df.fillna("", [text]).join(encoded, text)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; zero rows stay zero."""
    wide = matrix.astype(np.float64)
    norms = np.linalg.norm(wide, axis=1, keepdims=True)
    return np.divide(wide, norms, out=np.zeros_like(wide), where=norms > 0)


def rows_of(column: pa.Array) -> np.ndarray:
    """An Arrow list column of equally long, non-null vectors as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    if column.null_count or (len(lengths) and (lengths != lengths[0]).any()):
        raise ValueError("vectors must be non-null and equally long")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype=flat.dtype)


def list_array(matrix: np.ndarray) -> pa.ListArray:
    """A matrix as an Arrow list column."""
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * width, matrix.ravel())
