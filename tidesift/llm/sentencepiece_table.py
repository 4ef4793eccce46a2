"""SentencePiece by a table of distinct chunks.

Pieces of the model do not cross white space, so a text's ids are those of its chunks, one after the other.

A task cuts its texts some megabytes at a time, looks their distinct chunks up in its worker's table, segments those
that it does not hold, and puts ids in place. The table is bounded: past that, rare chunks are forgotten and segmented
again where they come back. No row moves and nothing is staged, so the work needs no disk, and that of a task is bounded
by its texts, not by how often a word occurs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidesift.llm.chunks import ENCODED, ChunkMemory, by_space, spread
from tidesift.llm.textbytes import pieces

MARK = "▁"
#: Bytes of text that are cut together, and chunks that a worker remembers: what a worker holds is a multiple of both.
PIECE, REMEMBERED = 2 << 20, 250_000


@lru_cache(maxsize=2)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_model(path: str) -> None:
    """Refuses models for which chunks could not be segmented by themselves."""
    sp = processor(path)
    crossing = [p for p in map(sp.id_to_piece, range(sp.get_piece_size())) if MARK in p.lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross white space: {crossing[:3]}")
    if sp.encode("  a  b ", out_type=str) != sum((sp.encode(c, out_type=str) for c in ("  a", " b")), []) + [MARK]:
        raise ValueError("the model's normaliser changes white space")


def _cuts(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """A mark in the text is segmented like a space."""
    return by_space(pc.replace_substring(column.cast(pa.large_string()), MARK, " "))


@lru_cache(maxsize=2)
def _table(path: str) -> ChunkMemory:
    sp = processor(path)

    def segment(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))]
        for start in range(0, len(chunks), ENCODED):
            words = chunks.slice(start, ENCODED).to_pylist()
            found = sp.encode(words, num_threads=1)
            found = [ids if w else [sp.piece_to_id(MARK)] for w, ids in zip(words, found, strict=True)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            parts.append((np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes))
        ids, sizes = zip(*parts)
        return np.concatenate(ids), np.concatenate(sizes)

    return ChunkMemory(segment, REMEMBERED)


@lru_cache(maxsize=2)
def _piece_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all pieces, their lengths, and which pieces decode by rule instead."""
    sp = processor(path)
    out, special = [], []
    for i in range(sp.get_piece_size()):
        by_rule = sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
        special.append(by_rule and not sp.is_control(i))
        if sp.is_control(i):
            out.append(b"")
        elif sp.is_byte(i):
            out.append(bytes([int(sp.id_to_piece(i)[3:5], 16)]))
        else:
            out.append(sp.id_to_piece(i).replace(MARK, " ").encode())
    return np.frombuffer(b"".join(out), np.uint8), np.array([len(b) for b in out]), np.array(special)


def decode_ids(ids: np.ndarray, counts: np.ndarray, path: str) -> pa.Array:
    """Texts of rows with so many ids each, as the library decodes them."""
    data, lengths, special = _piece_bytes(path)
    sp = processor(path)
    body = spread(data, lengths, ids)
    ends = np.concatenate(([0], np.cumsum(lengths[ids])))
    id_bounds = np.concatenate(([0], np.cumsum(counts)))
    bounds = ends[id_bounds]
    lead = np.zeros(len(body), bool)
    full = bounds[1:] > bounds[:-1]
    heads = bounds[:-1][full]
    lead[heads] = body[heads] == 0x20  # the space that encoding adds in front
    bounds = bounds - np.concatenate(([0], np.cumsum(lead)))[bounds]
    body = body[~lead]
    buffers = [pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(body))]
    out = pa.LargeStringArray.from_buffers(len(counts), *buffers)
    odd = np.add.reduceat(np.append(special[ids], False), id_bounds[:-1]) * (counts > 0) if len(counts) else counts
    try:
        out.validate(full=True)
        broken = np.flatnonzero(odd)
    except pa.ArrowInvalid:
        broken = np.arange(len(counts))  # bytes that are no text: the library's own way
    if len(broken):
        fixed = out.cast(pa.large_binary()).to_pylist()
        for i in broken:
            fixed[i] = sp.decode(ids[id_bounds[i] : id_bounds[i + 1]].tolist()).encode()
        out = pa.array(fixed, pa.large_binary()).cast(pa.large_string())
    return out


def encode(df: DataFrame, text: str, path: str, ids: str = "ids", decoded: str = "decoded", end: bool = True) -> DataFrame:
    """The rows, without their text, with its ids (an end id last) and what these decode to.

    Null counts as empty: the end id alone, decoded to an empty text. Repeated rows stay repeated. Columns named like
    the new ones are replaced. ``path`` must lead to the model on every executor.
    """
    check_model(path)
    df = df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if f.name.lower() not in (ids, decoded) or f.name == text])
    kept = [f for f in df.schema.fields if f.name != text]
    schema = StructType([*kept, StructField(ids, ArrayType(IntegerType())), StructField(decoded, StringType())])
    eos = processor(path).eos_id()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(path)
        for batch in batches:
            for piece in pieces(batch, text, PIECE):
                chunks, codes, sizes = _cuts(piece.column(text))
                values, n_ids = table.find(chunks)
                flat = spread(values, n_ids, codes).astype(np.int64)
                total = np.concatenate(([0], np.cumsum(n_ids[codes])))
                bounds = total[np.concatenate(([0], np.cumsum(sizes)))]
                if end:
                    flat = np.insert(flat, bounds[1:], eos)
                    bounds = bounds + np.arange(len(bounds))
                texts_out = decode_ids(flat, np.diff(bounds), path)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
                columns = [*(piece.column(f.name) for f in kept), lists, texts_out.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return df.mapInArrow(run, schema)
