"""Texts of an Arrow batch as numbered space-free chunks, a bounded number of bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text handled at a time (or one longer text)
CHUNK_BYTES = 16_000_000


def text_slices(batch: pa.RecordBatch, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.Array, pa.Array]]:
    """``doc_id`` and ``text`` (null: empty) of runs of rows with at most ``limit`` bytes of text, or one row."""
    ids = batch.column("doc_id")
    texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield ids.slice(at, to - at), texts.slice(at, to - at)
        at = to


def numbered(texts: pa.Array, blanks: bytes = b"") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct chunks between spaces (or ASCII ``blanks``), the number of each chunk of each
    text in order, and where each text's chunks begin.  Touching blanks leave empty chunks."""
    if blanks and (data := texts.buffers()[2]) is not None:
        table = np.arange(256, dtype=np.uint8)
        table[list(blanks)] = 0x20
        offsets = texts.buffers()[1]
        texts = pa.LargeStringArray.from_buffers(
            len(texts), offsets, pa.py_buffer(table[np.frombuffer(data, np.uint8)]), None, 0, texts.offset)
    cut = pc.split_pattern(texts, " ")
    names = cut.flatten().dictionary_encode()
    starts = cut.offsets.to_numpy().astype(np.int64)
    return names.dictionary.to_pylist(), names.indices.to_numpy().astype(np.int64), starts - starts[0]


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``values[start[i]:start[i] + size[i]]`` for all ``i``, one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 2**31 else np.int64
    at = np.repeat((start - ends + size).astype(kind), size)
    at += np.arange(total, dtype=kind)
    return values[at]
