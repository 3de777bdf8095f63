"""Byte-level BPE with a sentencepiece model that is written straight from a rank file.

Each byte stands for one printable character, so a vocabulary entry is a piece of as many
characters as it has bytes. A piece's score is its negative rank: the model's merges, best score
first and leftmost among equals, are then those of the rank file. Normalisation is the identity.
"""

from __future__ import annotations

import base64
import itertools
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.session import give_back, ship_package

#: Characters after which a text may be cut before white space, to bound a task's memory.
SEGMENT = 1 << 16
#: Pre-tokens whose ids a task remembers.
REMEMBERED = 300_000

_NORMAL, _UNKNOWN, _BPE = 1, 2, 2
_GAP = re.compile(r"(?<=\S)\s")


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Vocabulary of a rank file: base64 of the bytes, a space, the rank.

    A local path is read on the driver, any other by Spark; a vocabulary has a fixed, small size.
    """
    if "://" in path:
        lines = [row[0] for row in spark.read.text(path).collect()]
    else:
        with open(path, encoding="ascii") as file:
            lines = file.read().splitlines()
    ranks = {}
    for line in filter(None, lines):
        token, rank = line.split()
        ranks[base64.b64decode(token)] = int(rank)
    return ranks


def byte_characters() -> str:
    """256 distinct characters that no normaliser and no pattern treats as white space."""
    return "".join(chr(0x4E00 + i) for i in range(256))


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """Protocol buffer of a sentencepiece BPE model; ids are ranks, one more id is unknown.

    Ranks need not be dense: ids without an entry get placeholders that no text produces.
    """
    chars = byte_characters()
    missing = [i for i in range(256) if bytes([i]) not in ranks]
    if missing:
        raise ValueError(f"{len(missing)} bytes have no rank")
    top = max(ranks.values())
    by_rank = {rank: token for token, rank in ranks.items()}
    if len(by_rank) != len(ranks):
        raise ValueError("two entries share a rank")
    pieces = []
    for rank in range(top + 2):
        token = by_rank.get(rank)
        if token is not None:
            name, kind = "".join(chars[b] for b in token), _NORMAL
        else:
            name, kind = ("<unk>", _UNKNOWN) if rank > top else (f"<unused{rank}>", _NORMAL)
        body = _bytes(1, name.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank))
        pieces.append(_bytes(1, body + _number(3, kind)))
    trainer = b"".join(
        _number(*x)
        for x in ((3, _BPE), (4, top + 2), (40, top + 1), (41, -1), (42, -1), (43, -1))
    )
    normaliser = _bytes(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(pieces) + _bytes(2, trainer) + _bytes(3, normaliser)


def _segments(text: str) -> Iterator[str]:
    """Pieces of a text, cut only between other characters and white space.

    No pre-token of a pattern that lets white space stand at a token's start alone spans a cut.
    """
    start = 0
    while start < len(text):
        gap = _GAP.search(text, start + SEGMENT)
        end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end


def _encoder(model, pattern: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        import sentencepiece

        data, ranks = model.value
        processor = sentencepiece.SentencePieceProcessor(model_proto=data)
        find = regex.compile(pattern).findall
        table = dict(enumerate(byte_characters()))
        known: dict[str, list[int]] = {}

        def ids(segment: str) -> list[int]:
            parts = find(segment)
            new = list(set(parts).difference(known))
            if new:
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new = list(set(parts))
                raw = [part.encode("utf-8") for part in new]
                mapped = [part.decode("latin-1").translate(table) for part in raw]
                found = processor.encode(mapped, out_type=int, num_threads=1)
                for part, own, merged in zip(new, raw, found):
                    whole = ranks.get(own)
                    known[part] = merged if whole is None else [whole]
            return list(itertools.chain.from_iterable(map(known.__getitem__, parts)))

        for batch in (batch.slice(i, 256) for batch in batches for i in range(0, batch.num_rows, 256)):
            ends, flat = [0], []
            for text in batch.column(1).to_pylist():
                size = ends[-1]
                for segment in _segments(text or ""):
                    part = ids(segment)
                    flat.append(np.fromiter(part, np.int32, len(part)))
                    size += len(part)
                ends.append(size)
            values = np.concatenate(flat) if flat else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
            yield pa.record_batch([batch.column(0), lists], ["id", "tokens"])

    return run


def _decoder(pieces) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, starts, sizes = pieces.value
        for batch in (batch.slice(i, 256) for batch in batches for i in range(0, batch.num_rows, 256)):
            out = []
            for tokens in batch.column(1):
                ids = np.asarray(tokens.values) if tokens.is_valid else np.zeros(0, np.int32)
                size = sizes[ids]
                ends = np.cumsum(size)
                total = int(ends[-1]) if ids.size else 0
                shift = np.repeat(starts[ids] - (ends - size), size)
                out.append(data[shift + np.arange(total)].tobytes())
            yield pa.record_batch([*batch.columns, pa.array(out, pa.binary())], ["id", "tokens", "decoded"])

    return run


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id_col, tokens array<int>)``: ids of each row's whole text.

    Every match of ``pattern`` is encoded for itself, without special tokens. Null and empty texts
    give an empty array; ids may be null or repeat, rows are kept one for one; other columns are
    ignored. A text is handled in segments, a task remembers a bounded number of pre-tokens. The
    model is broadcast: a vocabulary's size does not follow the data.
    """
    spark = docs.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast((serialise_model(ranks), ranks))
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", kind), T.StructField("tokens", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(give_back(_encoder(model, pattern)), schema).withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id") -> DataFrame:
    """``(id_col, tokens, decoded binary)``: the bytes that the ids stand for; null gives none."""
    spark = tokens.sparkSession
    ship_package(spark)
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    parts = [b""] * sizes.size
    for token, rank in ranks.items():
        parts[rank] = token
        sizes[rank] = len(token)
    starts = np.cumsum(sizes) - sizes
    pieces = spark.sparkContext.broadcast((np.frombuffer(b"".join(parts), np.uint8), starts, sizes))
    rows = tokens.select(F.col(id_col).alias("id"), "tokens")
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])
    return rows.mapInArrow(give_back(_decoder(pieces)), schema).withColumnRenamed("id", id_col)
