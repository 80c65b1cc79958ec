"""Encoding of whole corpora by a public tokenizer's vocabulary.

Arrow batches go to a worker, are cut into slices of a few megabytes and encoded by numpy (see bpe);
a worker keeps the words it has met, so its time goes with the bytes it reads. No shuffle.

Defined cases: an empty and a null text have no ids; strings that look like special tokens are
ordinary text; repeated documents come out each, in no order; texts of any length are encoded whole;
only the named columns are read, so extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm import bpe
from tallymark.session import spread


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of rows of about SLICE_BYTES."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + bpe.SLICE_BYTES, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def _run(vocabulary: str, ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe.encoder(vocabulary).encode
        for b in batches:
            if not b.num_rows:
                continue
            names = b.schema.names[:-1]
            for i, j, data, offsets in _slices(b.column(len(names))):
                tokens, ends = encode(data, offsets, ids)
                out = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens, pa.int32())) if ids else pa.array(np.diff(ends), pa.int32())
                yield pa.RecordBatch.from_arrays([*[b.column(k).slice(i, j - i) for k in range(len(names))], out], names=[*names, "_out"])

    return run


def _encoded(df: DataFrame, keep: list[Column | str], text: str, out: str, vocabulary: str | None, ids: bool) -> DataFrame:
    cut = spread(df.select(*keep, F.col(text).cast("string").alias("_text")))
    kind = "array<int>" if ids else "int"
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields[:-1])
    return cut.mapInArrow(_run(vocabulary or bpe.default_vocabulary(), ids), f"{kept}, _out {kind}").withColumnRenamed("_out", out)


def token_ids(df: DataFrame, keep: list[Column | str], text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """The kept columns and `ids`, array<int>."""
    return _encoded(df, keep, text, "ids", vocabulary, True)


def token_counts(df: DataFrame, keep: list[Column | str], text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """The kept columns and `n_tokens`, int."""
    return _encoded(df, keep, text, "n_tokens", vocabulary, False)
