"""Token ids in binary files: Simple-8b blocks in the order of documents.

A file holds blocks, each with whole documents, one after the other. A block ends with a line feed, which is what the
writer of text files puts behind a row, so files are written through Spark's committer to any file system.

Block, little-endian: magic, sizes (``HEADER``), document ids, one byte each for null ids, ids per document, words per
group of Simple-8b, words, CRC-32 of all that, line feed.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidesift.llm import simple8b
from tidesift.llm.chunks import ODD_SPACE, PIECE, ChunkMemory, by_word, spread
from tidesift.llm.textbytes import PLAIN, pieces, texts

MAGIC = b"S8BT"
#: magic, part, number in the part, ids before it in the part, documents, ids, groups, words
HEADER = struct.Struct("<4sIIQIQIQ")
#: Ids after which a block ends (a longer document is one block), and blocks in a file.
BLOCK_IDS, BLOCKS_PER_FILE = 1 << 16, 64
#: Chunks that go through the tokenizer as one text.
JOINED = 1_024


@dataclass
class Block:
    part: int
    number: int
    before: int
    doc_ids: np.ndarray
    nulls: np.ndarray
    counts: np.ndarray
    ids: np.ndarray | None


def pack(part: int, number: int, before: int, doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    words, groups = simple8b.encode(ids)
    body = b"".join(
        [
            HEADER.pack(MAGIC, part, number, before, len(counts), len(ids), len(groups), len(words)),
            doc_ids.astype("<i8").tobytes(), nulls.astype(np.uint8).tobytes(), counts.astype("<u8").tobytes(),
            groups.astype("<u2").tobytes(), words.astype("<u8").tobytes(),
        ]
    )
    return body + struct.pack("<I", zlib.crc32(body))


def unpack(content: bytes, decode: bool = True) -> Iterator[Block]:
    """Blocks of a file; without ``decode`` only their heads."""
    at = 0
    while at < len(content):
        magic, part, number, before, docs, n_ids, n_groups, n_words = HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("no block starts here")
        places = np.cumsum([HEADER.size, 8 * docs, docs, 8 * docs, 2 * n_groups, 8 * n_words]) + at
        stop = int(places[-1])
        if struct.unpack_from("<I", content, stop)[0] != zlib.crc32(memoryview(content)[at:stop]):
            raise ValueError("a block does not fit its checksum")
        doc_ids = np.frombuffer(content, "<i8", docs, places[0])
        nulls = np.frombuffer(content, np.uint8, docs, places[1]).astype(bool)
        counts = np.frombuffer(content, "<u8", docs, places[2]).astype(np.int64)
        ids = simple8b.decode(np.frombuffer(content, "<u8", n_words, places[4])) if decode else None
        yield Block(part, number, before, doc_ids, nulls, counts, ids)
        at = stop + 5  # checksum and line feed


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    # Spark runs as many workers as there are cores; threads of their own would only take memory and time from others.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _id_bytes(path: str) -> np.ndarray | None:
    """Bytes of text behind each id, or None where ids of joined chunks need not be those of the chunks."""
    tokenizer = _tokenizer(path)
    made = json.loads(tokenizer.to_str())
    first, added = made["pre_tokenizer"] or {}, made["added_tokens"]
    plain = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
    if not plain or made["normalizer"] or made["truncation"] or made["model"].get("dropout"):
        return None
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] or (PLAIN[list(a["content"].encode())] == 0).any() for a in added):
        return None
    # A byte is one character of a token's name.
    sizes = {i: len(token) for token, i in tokenizer.get_vocab().items()} | {a["id"]: len(a["content"].encode()) for a in added}
    out = np.zeros(max(sizes) + 1, np.int64)
    out[list(sizes)] = list(sizes.values())
    return out


def _encode_each(chunks: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    found = [e.ids for e in _tokenizer(path).encode_batch_fast(chunks, add_special_tokens=False)]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes


def _encode(chunks: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of chunks and how many each has.

    Chunks that begin with white space and end without go through the tokenizer joined, many at a time, and
    the bytes behind each id tell where a chunk ends: one list of ids instead of one for each chunk.
    """
    id_bytes = _id_bytes(path)
    if id_bytes is None:
        return _encode_each(chunks.to_pylist(), path)
    t = texts(chunks)
    full = np.flatnonzero(np.diff(t.bounds) > 0)
    joins = np.zeros(len(t), bool)
    joins[full] = (PLAIN[t.data[t.bounds[:-1][full]]] == 0) & (PLAIN[t.data[t.bounds[1:][full] - 1]] == 1)
    joins &= ~pc.match_substring_regex(chunks, ODD_SPACE).to_numpy(zero_copy_only=False)
    joined, alone = np.flatnonzero(joins), np.flatnonzero(~joins)
    parts = [_encode_each(chunks.take(pa.array(alone)).to_pylist(), path)]
    for start in range(0, len(joined), JOINED):
        own = chunks.take(pa.array(joined[start : start + JOINED]))
        whole = texts(own)
        ids = np.array(_tokenizer(path).encode_batch_fast([whole.data.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
        at, ends = np.cumsum(id_bytes[ids]), whole.bounds[1:]
        last = np.searchsorted(at, ends)
        fits = last[-1] == len(ids) - 1 and np.array_equal(at[last], ends)
        parts.append((ids, np.diff(last, prepend=-1)) if fits else _encode_each(own.to_pylist(), path))
    ids, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    # Back to the order of the chunks.
    back = np.argsort(np.concatenate((alone, joined)))
    return spread(ids, sizes, back), sizes[back]


@lru_cache(maxsize=2)
def _memory(path: str) -> ChunkMemory:
    return ChunkMemory(lambda chunks: _encode(chunks, path))


def tokenize(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and how many each has, as the tokenizer encodes whole texts without special tokens.

    Texts are cut where the tokenizer's own first step always cuts, and each distinct cut goes through it once
    while it is remembered.
    """
    chunks, codes, counts = by_word(column)
    values, sizes = _memory(path).find(chunks)
    ids = spread(values, sizes, codes)
    ends = np.concatenate(([0], np.cumsum(sizes[codes])))[np.concatenate(([0], np.cumsum(counts)))]
    return ids, np.diff(ends)


def write(df: DataFrame, path: str, doc_id: str, text: str, tokenizer: str, end_id: int | None, parts: int | None = None) -> None:
    """Encodes the texts and writes their ids in ascending order of ``doc_id``.

    Null ids come first and null texts count as empty. Rows of one id are ordered by their text's hash, so that an id
    that many rows share is spread over several parts. An empty table makes files without blocks. Other columns are
    not looked at. ``tokenizer`` must lead to its file on every executor.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("task", F.spark_partition_id())
    order = ["doc_id", "tie", "task"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                ids, counts = tokenize(piece.column("text"), tokenizer)
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(counts), end_id)
                    counts = counts + 1
                column = piece.column("doc_id")
                doc_ids, nulls = column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)
                ends = np.cumsum(counts)
                start = 0
                while start < len(counts):
                    done = ends[start - 1] if start else 0
                    stop = max(start + 1, int(np.searchsorted(ends, done + BLOCK_IDS - size, "right")))
                    held.append((doc_ids[start:stop], nulls[start:stop], counts[start:stop], ids[done : ends[stop - 1]]))
                    size += int(ends[stop - 1] - done)
                    start = stop
                    if size >= BLOCK_IDS or start < len(counts):
                        block = [np.concatenate(x) for x in zip(*held, strict=True)]
                        yield pa.RecordBatch.from_pydict({"block": pa.array([pack(part, number, before, *block)], pa.binary())})
                        number, before, held, size = number + 1, before + size, [], 0
        if held:
            block = [np.concatenate(x) for x in zip(*held, strict=True)]
            yield pa.RecordBatch.from_pydict({"block": pa.array([pack(part, number, before, *block)], pa.binary())})

    blocks = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie", "task")
    blocks = blocks.mapInArrow(run, "block binary").select(F.col("block").cast("string").alias("value"))
    blocks.write.option("maxRecordsPerFile", BLOCKS_PER_FILE).option("compression", "none").text(path)


def read(
    spark: SparkSession, path: str, make: Callable[[Block, np.ndarray], dict] | None = None, schema: str = "ids array<long>"
) -> DataFrame:
    """One row per document: ``doc_id, start`` (ids of all documents before it), ``n_tokens``, and what ``make`` gives
    for a block's documents, by default their ids.

    Files of bounded size are read whole. The driver sees one sum per part.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for block in unpack(content.as_py(), decode=False):
                    sums = {"part": pa.array([block.part]), "ids": pa.array([block.before + int(block.counts.sum())])}
                    yield pa.RecordBatch.from_pydict(sums)

    sums = files.mapInArrow(heads, "part long, ids long").groupBy("part").agg(F.max("ids").alias("ids")).collect()
    first, total = {}, 0
    for part, n in sorted((r["part"], r["ids"]) for r in sums):
        first[part] = total
        total += n
    make = make or id_lists

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for block in unpack(content.as_py()):
                    bounds = np.concatenate(([0], np.cumsum(block.counts)))
                    columns = {
                        "doc_id": pa.array(block.doc_ids, pa.int64(), mask=block.nulls),
                        "start": pa.array(bounds[:-1] + (first[block.part] + block.before)),
                        "n_tokens": pa.array(block.counts),
                    }
                    yield pa.RecordBatch.from_pydict(columns | make(block, bounds))

    return files.mapInArrow(run, f"doc_id long, start long, n_tokens long, {schema}")


def id_lists(block: Block, bounds: np.ndarray) -> dict:
    return {"ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(block.ids.astype(np.int64)))}


def id_checksums(block: Block, bounds: np.ndarray) -> dict:
    """CRC-32 of each document's ids as little-endian unsigned 32-bit numbers."""
    body = memoryview(block.ids.astype("<u4").tobytes())
    found = [zlib.crc32(body[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return {"ids_crc32": pa.array(found, pa.int64())}
