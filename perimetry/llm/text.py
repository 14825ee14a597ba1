"""Byte-level text helpers shared by the operators that run inside Arrow batches.

Texts travel as UTF-8 bytes: ASCII classes can then be applied with one table look-up per byte, and
every byte of a multi-byte character is 128 or more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add ``columns`` (replacing same-named ones), evaluated once per row however often they are used:
    the optimizer does not copy expressions through a generator."""
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def as_bytes(name: str = "text") -> Column:
    return F.col(name).cast("binary").alias(name)


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words between ASCII punctuation and blanks."""
    return text.translate(_TO_WORDS).split() if text else []


def blank_words(text: bytes | None) -> list[bytes]:
    """Words between `[\\x20\\x09-\\x0D]`, unchanged."""
    return text.split() if text else []


class WordHashes(dict):
    """Two 64-bit hashes per word, as 16 bytes, computed when first asked for."""

    def __missing__(self, word: bytes) -> bytes:
        digest = self[word] = xxhash.xxh3_128_digest(word)
        return digest


def word_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    """Two 64-bit hashes per word as an (n, 2) array; ``known`` keeps those already computed."""
    found = b"".join(map(known.__getitem__, words))
    if len(known) > 500_000:  # bounds memory only
        known.clear()
    return np.frombuffer(found, dtype=np.uint64).reshape(-1, 2)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )
