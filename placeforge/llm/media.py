"""Operator 7, media columns: ISO base media files (ISO/IEC 14496-12) as binary columns.

Method. ``encode`` writes a text's bytes losslessly as an 8-bit PCM track: every FRAME bytes are one sample, every
SYNC-th sample is a sync sample, samples lie in chunks of CHUNK. ``probe`` gets only the stored bytes: it walks the
nested boxes track by track, decodes each track's own sample tables (stts, stsc, stsz, stco or co64, stss) to the byte
range of every sample, and gives codec, duration and keyframe byte ranges without decoding payloads; further tracks than
the first are in ``more_tracks``. ``payload_of`` reads the first track's bytes back from those ranges. Files hold no
times or ids, so equal texts make equal files.

Scale. Each row by itself, no shuffle; a batch of rows is worked off AT_ONCE bytes or one row at a time.

Cases. A null or empty text is one sample of padding. Bytes that are no such file, or whose tables contradict each
other or the file's length (also a clock of 0 ticks a second, or samples beyond the file's bytes), give nulls with
``error`` set; null bytes give nulls. Counts are held against the boxes and the file before memory is taken for them,
and only the boxes on the way to a track's tables are opened, so nested boxes cost nothing. A track without stss has
only sync samples. Repeated rows are coded each; columns named like the new one are replaced.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes a sample, samples a chunk, samples from one sync sample to the next, samples a second of the track's clock.
FRAME, CHUNK, SYNC, RATE = 576, 16, 8, 8000
#: Bytes of a batch's rows that are worked on at once.
AT_ONCE = 8_000_000


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def padded(data: bytes, unit: int = FRAME) -> bytes:
    """Bytes 255 appended up to a positive multiple of the unit."""
    return data + b"\xff" * (unit - len(data) if len(data) < unit else -len(data) % unit)


def table(kind: bytes, values: np.ndarray, width: int = 1) -> bytes:
    """A full box with a count of entries and big-endian 32-bit numbers."""
    return box(kind, struct.pack(">II", 0, len(values) // width), np.asarray(values, dtype=">u4").tobytes())


def write_media(payload: bytes) -> bytes:
    """An ISO media file with one 8-bit PCM track of whole samples."""
    n = len(payload) // FRAME
    chunks = -(-n // CHUNK)
    duration = n * FRAME
    ftyp = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2mp41")
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    mvhd = box(b"mvhd", struct.pack(">IIIIIIHHII", 0, 0, 0, RATE, duration, 0x10000, 0x100, 0, 0, 0), matrix, bytes(24), struct.pack(">I", 2))
    tkhd = box(b"tkhd", struct.pack(">IIIIIIIIHHHH", 3, 0, 0, 1, 0, duration, 0, 0, 0, 0, 0x100, 0), matrix, bytes(8))
    mdhd = box(b"mdhd", struct.pack(">IIIIIHH", 0, 0, 0, RATE, duration, 0x55C4, 0))
    hdlr = box(b"hdlr", struct.pack(">II4s", 0, 0, b"soun"), bytes(12), b"pcm\x00")
    entry = box(b"raw ", bytes(6), struct.pack(">HIIHHHHI", 1, 0, 0, 1, 8, 0, 0, RATE << 16))
    stsd = box(b"stsd", struct.pack(">II", 0, 1), entry)
    stts = table(b"stts", np.array([n, FRAME]), 2)
    stss = table(b"stss", np.arange(1, n + 1, SYNC))
    runs = [[1, CHUNK, 1]] if n % CHUNK == 0 else [[1, CHUNK, 1], [chunks, n % CHUNK, 1]] if chunks > 1 else [[1, n, 1]]
    stsc = table(b"stsc", np.array(runs).ravel(), 3)
    stsz = box(b"stsz", struct.pack(">III", 0, FRAME, n))
    dinf = box(b"dinf", box(b"dref", struct.pack(">II", 0, 1), box(b"url ", struct.pack(">I", 1))))
    smhd = box(b"smhd", struct.pack(">IHH", 0, 0, 0))

    def moov(first: int) -> bytes:
        stco = table(b"stco", first + np.arange(chunks, dtype=np.int64) * CHUNK * FRAME)
        stbl = box(b"stbl", stsd, stts, stss, stsc, stsz, stco)
        return box(b"moov", mvhd, box(b"trak", tkhd, box(b"mdia", mdhd, hdlr, box(b"minf", smhd, dinf, stbl))))

    head = len(ftyp) + len(moov(0)) + 8
    return ftyp + moov(head) + box(b"mdat", payload)


def boxes(data: memoryview, start: int = 0, end: int | None = None) -> Iterator[tuple[bytes, int, int]]:
    """The boxes side by side in a range: kind, and where the body starts and ends."""
    end = len(data) if end is None else end
    while start < end:
        if end - start < 8:
            raise ValueError("a box header is cut")
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            size, body = struct.unpack_from(">Q", data, body)[0], body + 8
        elif size == 0:
            size = end - start
        if size < body - start or start + size > end:
            raise ValueError("a box exceeds its parent")
        yield kind, body, start + size
        start += size


def inside(data: memoryview, place: tuple[int, int], *kinds: bytes) -> tuple[int, int]:
    """The body of the first box on this way down."""
    for kind in kinds:
        place = next(((a, b) for k, a, b in boxes(data, *place) if k == kind), None)
        if place is None:
            raise ValueError(f"no box {kind.decode('latin-1')}")
    return place


def numbers(data: memoryview, start: int, end: int, width: int, kind: str = ">u4") -> np.ndarray:
    """The entries of a table box as rows of ``width`` numbers."""
    count = struct.unpack_from(">I", data, start + 4)[0]
    if start + 8 + count * width * int(kind[-1]) > end:
        raise ValueError("a table exceeds its box")
    return np.frombuffer(data, kind, count * width, start + 8).astype(np.int64).reshape(count, width)


def sample_ranges(data: memoryview, tables: dict[bytes, tuple[int, int]], duration: int) -> np.ndarray:
    """Offset and length of every sample of a track."""
    start, end = tables[b"stsz"]
    each, n = struct.unpack_from(">II", data, start + 4)
    if each * n > len(data):
        raise ValueError("more samples than the file has bytes")
    sizes = np.full(n, each, np.int64) if each else numbers(data, start + 4, end, 1)[:, 0]
    times = numbers(data, *tables[b"stts"], 2)
    offsets = numbers(data, *tables[b"stco"], 1)[:, 0] if b"stco" in tables else numbers(data, *tables[b"co64"], 1, ">u8")[:, 0]
    runs = numbers(data, *tables[b"stsc"], 3)
    if len(offsets) and (not len(runs) or runs[0, 0] != 1):
        raise ValueError("the first chunk has no samples")
    per_chunk = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], len(offsets) + 1))) if len(offsets) else np.zeros(0, np.int64)
    if times[:, 0].sum() != n or per_chunk.sum() != n or sum(a * b for a, b in times.tolist()) != duration:
        raise ValueError("sample tables contradict each other")
    offsets, per_chunk = offsets[per_chunk > 0], per_chunk[per_chunk > 0]
    first, upto = np.cumsum(per_chunk) - per_chunk, np.cumsum(sizes) - sizes
    starts = np.repeat(offsets - upto[first], per_chunk) + upto
    if n and (starts.min() < 0 or (starts + sizes).max() > len(data) or sizes.sum() > len(data)):
        raise ValueError("a sample lies beyond the file")
    return np.stack([starts, sizes], axis=1)


def read_track(data: memoryview, place: tuple[int, int]) -> dict:
    mdia = inside(data, place, b"mdia")
    mdhd, _ = inside(data, mdia, b"mdhd")
    scale, duration = struct.unpack_from(">IQ", data, mdhd + 20) if data[mdhd] == 1 else struct.unpack_from(">II", data, mdhd + 12)
    if not scale:
        raise ValueError("the clock has no ticks")
    handler = bytes(data[inside(data, mdia, b"hdlr")[0] + 8 :][:4]).decode("latin-1")
    tables: dict[bytes, tuple[int, int]] = {}
    for kind, start, end in boxes(data, *inside(data, mdia, b"minf", b"stbl")):
        tables.setdefault(kind, (start, end))
    codec = bytes(data[tables[b"stsd"][0] + 12 :][:4]).decode("latin-1").strip()
    ranges = sample_ranges(data, tables, duration)
    sync = numbers(data, *tables[b"stss"], 1)[:, 0] - 1 if b"stss" in tables else np.arange(len(ranges))
    if len(sync) and (sync.min() < 0 or sync.max() >= len(ranges)):
        raise ValueError("a sync sample does not exist")
    return {"codec": codec, "handler": handler, "timescale": scale, "duration": duration, "samples": len(ranges), "ranges": ranges, "keyframes": ranges[sync]}


def read_tracks(data: bytes) -> list[dict]:
    """codec, handler, timescale, duration, samples and, as (n, 2) arrays of offset and length, sample and keyframe ranges of each track."""
    view = memoryview(data)
    tops = list(boxes(view))
    tracks = [read_track(view, (a, b)) for kind, start, end in tops if kind == b"moov" for k, a, b in boxes(view, start, end) if k == b"trak"]
    if not tracks:
        raise ValueError("no track")
    return tracks


def read_media(data: bytes) -> dict:
    """The first track of ``read_tracks``."""
    return read_tracks(data)[0]


def payload_of(data: bytes, ranges: np.ndarray) -> bytes:
    """The track's bytes, read from the ranges; neighbours are read at once."""
    if not len(ranges):
        return b""
    breaks = np.flatnonzero(ranges[1:, 0] != ranges[:-1].sum(axis=1)) + 1
    heads, tails = np.append(0, breaks), np.append(breaks, len(ranges)) - 1
    return b"".join(data[a:b] for a, b in zip(ranges[heads, 0].tolist(), ranges[tails].sum(axis=1).tolist(), strict=True))


def with_column(df: DataFrame, name: str, kind: str, pa_type: pa.DataType, source: str, one) -> DataFrame:
    """``df`` with ``name`` = one(value of source) for each row, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at, made, size = batch.column(source), 0, [], 0
            for k in range(len(values)):
                value = values[k].as_py()
                made.append(one(value))
                size += len(value or "")
                if size > AT_ONCE or k + 1 == len(values):
                    part = batch.slice(at, len(made))
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(made, pa_type)], [*kept, name])
                    at, made, size = k + 1, [], 0

    kept = [c for c in df.columns if c.lower() != name.lower()]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept)
    return df.mapInArrow(run, f"{fields}, `{name}` {kind}")


def encode(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """``df`` with the binary column ``media``: the media file of each text."""
    return with_column(df, media, "binary", pa.binary(), text, lambda x: write_media(padded((x or "").encode())))


TRACK = [("codec", pa.string()), ("duration_s", pa.float64()), ("samples", pa.int64()), ("keyframes", pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64())])))]
PROBE = pa.struct([*TRACK, ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("more_tracks", pa.list_(pa.struct(TRACK))), ("error", pa.string())])
PROBE_SQL = "struct<codec:string,duration_s:double,samples:bigint,keyframes:array<struct<offset:bigint,length:bigint>>,payload_bytes:bigint,payload_sha256:string,tail_crc32:bigint,media_bytes:bigint,media_sha256:string,feature:string,more_tracks:array<struct<codec:string,duration_s:double,samples:bigint,keyframes:array<struct<offset:bigint,length:bigint>>>>,error:string>"


def track_columns(track: dict) -> dict:
    return {"codec": track["codec"], "duration_s": track["duration"] / track["timescale"], "samples": track["samples"], "keyframes": [{"offset": a, "length": b} for a, b in track["keyframes"].tolist()]}


def probe_one(data: bytes | None) -> dict | None:
    if data is None:
        return None
    stored = {"media_bytes": len(data), "media_sha256": hashlib.sha256(data).hexdigest()}
    try:
        found, *more = read_tracks(data)
        payload = payload_of(data, found["ranges"])
    except (ValueError, KeyError, IndexError, OverflowError, struct.error) as e:
        return stored | {"error": f"{type(e).__name__}: {e}"[:200]}
    keys = found["keyframes"]
    feature = f"{found['handler']}/{found['codec']};timescale={found['timescale']};duration={found['duration']};samples={found['samples']};keyframes={len(keys)};keyframe_bytes={int(keys[:, 1].sum())};keyframe_crc32={zlib.crc32(keys.astype('<i8').tobytes()):08x}"
    own = {"payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-32:]), "feature": feature, "more_tracks": [track_columns(t) for t in more], "error": None}
    return stored | track_columns(found) | own


def probe(df: DataFrame, media: str = "media", into: str = "probe") -> DataFrame:
    """``df`` with the struct ``into``: what the stored bytes say."""
    return with_column(df, into, PROBE_SQL, PROBE, media, probe_one)


def media_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes and the probe's columns for each row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    coded = encode(rows).select("doc_id", "n_bytes", "media")
    return probe(coded).select("doc_id", "n_bytes", "probe.*")
