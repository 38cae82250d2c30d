"""Media columns in Ogg containers.

Reading verifies every page's checksum, reassembles packets from lacing values, also across pages, demultiplexes the
logical streams by serial number and derives each packet's time from granule positions. Writing lays two logical streams
of 8-bit samples into one physical stream, their pages interleaved by time, so that a stored payload exercises all of it:
the payload is cut into packets of PACKET samples that go to the two streams in turn, and the reader puts them back in the
order of their times.

The page checksum is a CRC-32 of polynomial 0x04c11db7, not reflected, with a zero start. It equals zlib's reflected CRC
of the bit-reversed bytes with the start value undone, so both directions run at the speed of zlib.

Defined cases: a null or empty text is a payload of 64 zero bytes; equal texts give equal containers (serial numbers come
from the stream's index); a damaged page, a gap in page numbers, a missing end or a truncated packet raises OggError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import blocks, kept, set_aside

RATE = 8000  # samples a second
PACKET = 4000  # samples of a packet: half a second
SERIALS = (0x54444D30, 0x54444D31)
_MAGIC = b"TDM8"  # header packet: magic, rate, packet size, stream index, number of streams
_PAGE = struct.Struct("<4sBBqIIIB")
_REVERSE = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
CONTINUED, FIRST, LAST = 1, 2, 4


class OggError(ValueError):
    """The bytes are no intact Ogg stream."""


def page_crc(page: bytes) -> int:
    """The checksum of a page whose own checksum field is zero."""
    reflected = zlib.crc32(page.translate(_REVERSE), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(reflected.to_bytes(4, "little").translate(_REVERSE), "big")


def _lacing(size: int) -> list[int]:
    return [255] * (size // 255) + [size % 255]


def write_pages(packets: list[bytes], granules: list[int], serial: int) -> list[tuple[int, bytes]]:
    """Pages of one logical stream as (granule position, bytes); the first packet has a page of its own."""
    pages: list[tuple[int, bytes]] = []
    values: list[int] = []
    body: list[bytes] = []
    granule = -1
    split = False

    def close(last: bool) -> None:
        nonlocal values, body, granule, split
        flags = (CONTINUED if split else 0) | (FIRST if not pages else 0) | (LAST if last else 0)
        head = _PAGE.pack(b"OggS", 0, flags, granule, serial, len(pages), 0, len(values)) + bytes(values)
        page = head + b"".join(body)
        pages.append((granule, page[:22] + page_crc(page).to_bytes(4, "little") + page[26:]))
        split = bool(values) and values[-1] == 255
        values, body, granule = [], [], -1

    for k, (packet, at) in enumerate(zip(packets, granules, strict=True)):
        rest, done = _lacing(len(packet)), 0
        while rest:
            room = rest[: 255 - len(values)]
            values += room
            size = sum(room)
            body.append(packet[done : done + size])
            done += size
            rest = rest[len(room) :]
            if not rest:
                granule = at
            last = k == len(packets) - 1 and not rest
            if last or k == 0 and not rest or len(values) == 255:
                close(last)
    return pages


@dataclass
class LogicalStream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)  # of the page on which the packet ends; -1 if the page ends more packets after it
    pages: int = 0
    ended: bool = False


def read_streams(data: bytes) -> dict[int, LogicalStream]:
    """All logical streams of a physical stream, checksums and page numbers verified."""
    streams: dict[int, LogicalStream] = {}
    partial: dict[int, list[bytes]] = {}
    at, view = 0, memoryview(data)
    while at < len(data):
        if len(data) - at < _PAGE.size:
            raise OggError("a page header is cut off")
        magic, version, flags, granule, serial, number, crc, n = _PAGE.unpack_from(data, at)
        if magic != b"OggS" or version:
            raise OggError(f"no page at byte {at}")
        values = data[at + 27 : at + 27 + n]
        start = at + 27 + n
        end = start + sum(values)
        if len(values) < n or end > len(data):
            raise OggError("a page is cut off")
        if page_crc(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != crc:
            raise OggError(f"wrong checksum of page {number} of stream {serial:#x}")
        s = streams.get(serial)
        if s is None:
            if not flags & FIRST:
                raise OggError("a stream lacks its first page")
            s = streams[serial] = LogicalStream(serial)
        elif flags & FIRST or s.ended:
            raise OggError("a page outside its stream")
        if number != s.pages:
            raise OggError(f"page {s.pages} of stream {serial:#x} is missing")
        s.pages += 1
        held = partial.pop(serial, None)
        if (held is not None) != bool(flags & CONTINUED):
            raise OggError("a packet is cut off")
        parts = held or []
        ends = 0
        size = 0
        for v in values:
            size += v
            if v < 255:
                parts.append(bytes(view[start : start + size]))
                start += size
                size = 0
                s.packets.append(b"".join(parts))
                s.granules.append(-1)
                parts = []
                ends += 1
        if values and values[-1] == 255:
            parts.append(bytes(view[start : start + size]))
            partial[serial] = parts
        if ends:
            s.granules[-1] = granule
        s.ended = bool(flags & LAST)
        at = end
    if partial or not all(s.ended for s in streams.values()):
        raise OggError("a stream has no end")
    return streams


def packet_starts(s: LogicalStream) -> list[int]:
    """First sample of each data packet, counted back from the granule position of the page that ends it.

    A granule position is the end of the last packet that the page completes; earlier packets of that page end where
    their successor in this stream began, less the samples that lie in the other stream in between.
    """
    _, _, size, _, n = _header(s)
    starts = [0] * len(s.packets)
    for i in range(len(s.packets) - 1, 0, -1):
        starts[i] = s.granules[i] - len(s.packets[i]) if s.granules[i] >= 0 else starts[i + 1] - size * n
    return starts[1:]


def _header(s: LogicalStream) -> tuple[bytes, int, int, int, int]:
    if not s.packets or len(s.packets[0]) != 16 or s.packets[0][:4] != _MAGIC:
        raise OggError("no header packet")
    return struct.unpack("<4sIIHH", s.packets[0])


def store(payload: bytes) -> bytes:
    """The payload's samples as a physical stream of two logical streams with interleaved pages."""
    streams = []
    for k, serial in enumerate(SERIALS):
        offsets = range(k * PACKET, len(payload), PACKET * len(SERIALS))
        packets = [struct.pack("<4sIIHH", _MAGIC, RATE, PACKET, k, len(SERIALS)), *(payload[o : o + PACKET] for o in offsets)]
        granules = [0, *(min(o + PACKET, len(payload)) for o in offsets)]
        streams.append(write_pages(packets, granules, serial))
    heads = [pages[0] for pages in streams]
    rest, latest = [], [0] * len(streams)
    for k, pages in enumerate(streams):
        for i, (granule, page) in enumerate(pages[1:]):
            latest[k] = max(latest[k], granule)  # a page that ends no packet stands where the stream is
            rest.append((latest[k], k, i, page))
    return b"".join(p for _, p in heads) + b"".join(x[-1] for x in sorted(rest, key=lambda x: x[:3]))


def load(media: bytes) -> tuple[bytes, dict[str, float]]:
    """The payload in a stored container, and the container's features."""
    streams = read_streams(media)
    timed = []
    for s in streams.values():
        timed += zip(packet_starts(s), s.packets[1:], strict=True)
    timed.sort(key=lambda x: x[0])
    at = 0
    for start, packet in timed:
        if start != at:
            raise OggError(f"samples {at} to {start} are missing")
        at += len(packet)
    payload = b"".join(p for _, p in timed)
    samples = np.frombuffer(payload, np.uint8)
    level = samples.astype(np.float32) - 128
    return payload, {
        "streams": len(streams),
        "pages": sum(s.pages for s in streams.values()),
        "packets": len(timed),
        "seconds": len(payload) / RATE,
        "mean": float(samples.mean(dtype=np.float64)) if len(samples) else 0.0,
        "rms": float(np.sqrt((level * level).mean(dtype=np.float64))) if len(samples) else 0.0,
        "crossings": int(np.count_nonzero((samples[1:] < 128) != (samples[:-1] < 128))),
    }


def payload_of(text: str) -> tuple[int, bytes]:
    """UTF-8 bytes of a text and their number before padding with zero bytes to a positive multiple of 64."""
    raw = text.encode()
    return len(raw), raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))


def to_media(docs: DataFrame, text: str = "text", media: str = "media", keep: list[str] | None = None) -> DataFrame:
    """Rows with the columns `keep` (all but text if not given), n_bytes, and each text stored as Ogg in a binary column."""
    docs = set_aside(docs, "n_bytes", media)
    rest = [c for c in docs.columns if c != text] if keep is None else keep
    schema = docs.select(*rest).schema.add("n_bytes", "long").add(media, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, text):
            made = [payload_of(x) for x in texts]
            yield pa.RecordBatch.from_arrays([*kept(batch, rest), pa.array([n for n, _ in made], pa.int64()), pa.array([store(p) for _, p in made], pa.binary())], names=[*rest, "n_bytes", media])

    return docs.select(*dict.fromkeys([*rest, text])).mapInArrow(run, schema)


def media_features(rows: DataFrame, media: str = "media") -> DataFrame:
    """Replace the binary column by what reading it gives: payload size and digests, size and digest of the stored form, features."""
    outputs = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}
    rows = set_aside(rows, *outputs)
    rest = [c for c in rows.columns if c != media]
    schema = rows.select(*rest).schema
    for name, kind in outputs.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for blob in batch.column(batch.schema.names.index(media)):
                data = blob.as_py()
                payload, f = load(data)
                feature = ";".join(f"{k}={v:.6g}" if isinstance(v, float) else f"{k}={v}" for k, v in f.items())
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*kept(batch, rest), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    read = media_features(to_media(docs, keep=["doc_id"]))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
