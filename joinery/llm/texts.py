"""Words and word hashes inside Arrow batches, and small column helpers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Every byte outside ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` becomes a blank, A-Z becomes a-z.
_ITEM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)
#: Java pattern of the same separators, for text that is already lower case.
ITEM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def blank_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased (other letters as they are)."""
    return text.lower().split() if text else []


def item_bytes(text: bytes) -> bytes:
    """``text`` with A-Z lower-cased and every separator byte as a blank (same length)."""
    return text.translate(_ITEM_BYTES)


def item_words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_ITEM_BYTES).split() if text else []


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def text_bytes(batch: pa.RecordBatch, name: str) -> Iterator[bytes | None]:
    """The texts of a batch as UTF-8, one at a time."""
    for value in batch.column(name).cast(pa.binary()):
        yield value.as_py()


def int64s(values) -> np.ndarray:
    """Unsigned 64-bit values as Spark's signed longs."""
    return np.ascontiguousarray(values, dtype=np.uint64).view(np.int64)


def lists(offsets: Sequence[int], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def free_columns(df: DataFrame, added: Sequence[str]) -> list[str]:
    """Input columns whose names an operator's own columns leave free."""
    taken = {a.lower() for a in added}
    return [c for c in df.columns if c.lower() not in taken]


def q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_word_array(text: Column, fold=ascii_lower) -> Column:
    """The item words of a text as an array, JVM-side. ``fold=F.lower`` is quicker; it
    also folds letters beyond A-Z, which moves no word boundary."""
    parts = F.split(fold(F.coalesce(text.cast("string"), F.lit(""))), ITEM_GAP)
    return F.filter(parts, lambda w: w != "")


def held_out(doc_id: Column) -> Column:
    """Rows no model learns from: crc32 of the id's text is a multiple of five."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0
