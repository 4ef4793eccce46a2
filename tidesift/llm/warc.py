"""WARC archives: written as one gzip member per record, read back by byte ranges.

Reading lets Spark's text reader cut files at the gzip magic: each task scans its byte range and owns the candidates
that start inside. A candidate is a record if its gzip and WARC headers decode and its checksum holds. The magic may
also occur within compressed bytes, which cuts a record in two: its parts are put together again, in the task if it
has both, else in a second step that sees only what was left at the borders of byte ranges.

Files must not be named ``.gz``: Spark would decompress these whole, in one task each.
"""

from __future__ import annotations

import hashlib
import string
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidesift.llm.textbytes import pieces
from tidesift.sources.scratch import stage

MAGIC = b"\x1f\x8b\x08"
#: Payloads from this many bytes on are written once.
SMALLEST = 1000
#: Keys that a group of copies is spread over.
SALTS = 32
SAFE = "".join(c for c in string.printable if not c.isspace() and c != "%")


def _gzip(content: bytes) -> bytes:
    coder = zlib.compressobj(6, zlib.DEFLATED, 31)
    return coder.compress(content) + coder.flush()


def member(record: bytes) -> bytes:
    """A gzip member that ends with a zero byte, as all below 16 MB do; an empty member behind it sees to the others."""
    out = _gzip(record)
    return out if out[-1] == 0 else out + _gzip(b"")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=SAFE)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: identical-payload-digest"]
        payload = b""
    lines += [f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(lines).encode() + payload + b"\r\n\r\n"


def revisits(pages: DataFrame) -> DataFrame:
    """``page_id, refers_to`` of pages whose payload another page with a larger id has too."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("size"))
    rows = stage(rows.where(F.col("size") >= SMALLEST), "digests")
    groups = rows.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    groups = groups.where("n > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    found = salted.join(groups, ["digest", "size", "salt"]).where("page_id < refers_to")
    return found.select("page_id", "refers_to").distinct()


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes a record per row. A null page counts as empty, a null url is left out.

    Of equal payloads of at least ``SMALLEST`` bytes the row with the largest id is the response and the others
    revisit it. Rows that repeat an id with other payloads keep their own; rows without an id are responses.
    Other columns are not looked at; an empty table makes files without records.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html")
    )
    # an id may stand for several pages: the payload's hash keeps them apart
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    copies = revisits(rows.select(F.struct("page_id", digest.alias("d")).alias("page_id"), "html"))
    copies = copies.select(
        F.col("page_id.page_id").alias("page_id"), F.col("page_id.d").alias("d"), F.col("refers_to.page_id").alias("refers_to")
    )
    copies = copies.where(F.col("page_id").isNotNull() & (F.col("page_id") < F.col("refers_to")))
    rows = rows.withColumn("d", digest).join(copies, ["page_id", "d"], "left").select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "html"):
                out = [
                    member(record(i, u, (h or "").encode(), r))[:-1]  # the line separator is the last byte
                    for i, u, h, r in zip(*(piece.column(k).to_pylist() for k in range(4)), strict=True)
                ]
                yield pa.RecordBatch.from_pydict({"record": pa.array(out, pa.binary())})

    records = rows.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", "\0").option("compression", "none").text(path)


def parse(content: bytes) -> dict | None:
    """Fields of a record; null if it is none."""
    head, cut, body = content.partition(b"\r\n\r\n")
    if not cut or not head.startswith(b"WARC/"):
        return None
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    number = lambda name: int(x) if (x := fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")) else None
    payload = body[: int(fields["Content-Length"])]
    return {
        "page_id": number("WARC-Record-ID"),
        "url": unquote(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
        "record_type": fields.get("WARC-Type"),
        "refers_to": number("WARC-Refers-To"),
        "payload_bytes": int(fields.get("WARC-Payload-Length", len(payload))),
        "payload_digest": fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or hashlib.sha1(payload).hexdigest(),
        "payload": payload,
    }


class Stitcher:
    """Puts records together from what lies between magics."""

    def __init__(self):
        self.coder, self.out, self.held = None, [], []
        self.lead: list[bytes] = []  # parts before the first record
        self.seen = False

    def feed(self, part: bytes) -> Iterator[bytes]:
        queue = [part]
        while queue:
            own = queue.pop(0)
            if self.coder is None:
                self.coder, self.out, self.held = zlib.decompressobj(31), [], []
            self.held.append(own)
            try:
                self.out.append(self.coder.decompress(MAGIC + own))
                start = self.out[0][:5]
                good = b"WARC/".startswith(start) if len(self.out) == 1 and not self.coder.eof else start == b"WARC/"
            except zlib.error:
                good = False
            if good and self.coder.eof:
                self.seen, self.coder = True, None
                yield b"".join(self.out)
            elif not good:
                if not self.seen:
                    self.lead.append(self.held[0])
                queue, self.coder = self.held[1:] + queue, None

    @property
    def tail(self) -> list[bytes]:
        return self.held if self.coder is not None else []


FIELDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives below a path, with payloads on demand; a revisit's payload is empty.

    Records cut off at the end of a file, and bytes between records, are passed over.
    """
    parts = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    parts = parts.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("part")
    )

    def row(found: dict | None, **more) -> dict:
        found = found or dict.fromkeys(NAMES)
        return found | {"payload": found["payload"] if payload else None, "path": None, "start": None, "lead": None, "tail": None} | more

    schema = FIELDS + ", path string, start long, lead array<binary>, tail array<binary>"
    arrow = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("path", pa.string()),
        ("start", pa.int64()), ("lead", pa.list_(pa.binary())), ("tail", pa.list_(pa.binary())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, work = None, Stitcher()

        def close() -> list[dict]:
            if at is None or not (work.lead or work.tail):
                return []
            return [row(None, path=at[0], start=at[1], lead=work.lead, tail=work.tail)]

        for batch in batches:
            out, held = [], 0
            for place in range(batch.num_rows):
                own = (batch.column(0)[place].as_py(), batch.column(1)[place].as_py())
                if own != at:
                    out += close()
                    at, work = own, Stitcher()
                for content in work.feed(batch.column(2)[place].as_py()):
                    if content and (found := parse(content)):
                        out.append(row(found))
                        held += len(content) if payload else 0
                if held > 1 << 24:
                    yield pa.RecordBatch.from_pylist(out, arrow)
                    out, held = [], 0
            yield pa.RecordBatch.from_pylist(out, arrow)
        yield pa.RecordBatch.from_pylist(close(), arrow)

    read_once = stage(parts.mapInArrow(run, schema), "records")

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        out, work = [], Stitcher()
        for _, left in rows.sort_values("start").iterrows():
            for part in left["lead"]:
                out += [row(f) for c in work.feed(bytes(part)) if (f := parse(c))]
            if len(left["tail"]):
                work = Stitcher()
            for part in left["tail"]:
                out += [row(f) for c in work.feed(bytes(part)) if (f := parse(c))]
        # by columns of objects, so that a null id does not turn ids into floats
        return pd.DataFrame({n: pd.array([r[n] for r in out], "Int64") if n in WHOLE else pd.Series([r[n] for r in out], dtype=object) for n in NAMES})

    whole = read_once.where(F.col("path").isNull()).select(*NAMES)
    borders = read_once.where(F.col("path").isNotNull()).select("path", "start", "lead", "tail")
    return whole.unionByName(borders.groupBy("path").applyInPandas(join, FIELDS))


WHOLE = {"page_id", "refers_to", "payload_bytes"}
