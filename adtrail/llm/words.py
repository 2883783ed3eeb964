"""Words of texts as bytes, and their hashes, for code that runs inside tasks.

Texts come as UTF-8 bytes (a Spark string cast to binary). ``bytes.split()`` parts them at exactly the six ASCII white
space characters, so its pieces are the words ``[^\\x20\\x09-\\x0D]+`` of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

#: Text bytes handled at once inside a task; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20

CONTINUATION = bytes(range(0x80, 0xC0))


def characters(data: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(data) if data.isascii() else len(data.translate(None, CONTINUATION))


def hashed(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    if not words:
        return np.zeros(0, np.uint64)
    column = np.empty(len(words), object)
    column[:] = words
    return pd.util.hash_array(column, categorize=False)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` words, by its start; runs that pass the end are left out."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    count = len(words) - n + 1
    out = np.zeros(count, np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[j : j + count]
    return mixed(out)


def run_starts(lengths: list[int], n: int) -> np.ndarray:
    """For texts of ``lengths`` words laid end to end: whether a run of ``n`` words that starts at a place stays in its text."""
    ends = np.repeat(np.cumsum(lengths), lengths)
    return np.arange(len(ends)) + n <= ends


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch that hold about ``most`` bytes of ``column`` each."""
    lengths = batch.column(column).cast(pa.large_binary())
    sizes = [0 if v is None else v for v in pa.compute.binary_length(lengths).to_pylist()]
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def by_block(work: Callable[[pa.RecordBatch], dict], schema: pa.Schema, column: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow: ``work`` gets a block of rows and gives columns."""

    def run(batches):
        for batch in batches:
            for start, end in blocks(batch, column):
                out = work(batch.slice(start, end - start))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return run
