"""Media columns: motion JPEG in AVI, written, indexed, decoded and cut into shots.

`store_texts` keeps a payload losslessly as 8-bit grey samples: frames of 24 x 24 samples, each frame a lossless JPEG (process
SOF3, predictor 1), all frames in one AVI file with an idx1 index. `read_media` parses the RIFF index, decodes the frames, which
are intra frames throughout, and compares histograms of neighbouring frames with a threshold that adapts to the frames before;
`clips` yields one row per shot with its times.

Huffman decoding runs in step over all frames of a batch: sample k of every frame is decoded by one vectorised operation.

Payload: the text in UTF-8 (null: empty), then bytes 255 up to a positive multiple of 576, so an empty text has one frame.
Texts are stored whole. Equal texts give equal media and features. Repeated rows give repeated results, ties do not arise,
other columns are ignored and an empty table gives an empty result. Files of other writers are read too where their frames are
baseline JPEG (module jpeg): their samples are the grey or luma ones. A null, broken or foreign media value (another container,
another JPEG process) raises ValueError in `decode_avi`; `read_media` turns it into a row with null fields and the reason in
`error`. A null id is carried like any other. Memory: about 1 MB of payload at a time, or one longer document, of which 2048
frames are worked on at once.
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

from . import jpeg as baseline
from .common import small_batches, text_or_empty

SIDE = 24
FRAME = SIDE * SIDE
FPS = 25
#: Lengths of the Huffman codes of the difference categories 0 to 8; together they leave the code of all ones unused.
CODE_LENGTHS = {2: 3, 3: 3, 4: 3, 5: 3, 6: 3, 7: 3, 0: 4, 1: 4, 8: 4}
#: Shots: bins of a histogram, differences in the adaptive window, deviations above its mean, least difference of a cut.
BINS, WINDOW, DEVIATIONS, LEAST = 16, 8, 3.0, 0.25
#: Frames worked on at once, which bounds the memory of a long document's arrays, and bytes of payload or media in a batch.
AT_ONCE, BATCH_BYTES = 2048, 1 << 20


def _canonical(lengths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Category -> (code, length), codes given in order of length, then of the table."""
    code = at = 0
    out = {}
    for symbol, length in sorted(lengths.items(), key=lambda x: x[1]):
        code <<= length - at
        out[symbol] = (code, length)
        code, at = code + 1, length
    return out


_CODES = _canonical(CODE_LENGTHS)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _jpeg_header() -> bytes:
    counts = bytes(sum(v == n for v in CODE_LENGTHS.values()) for n in range(1, 17))
    symbols = bytes(s for s, _ in sorted(CODE_LENGTHS.items(), key=lambda x: x[1]))
    return (
        b"\xff\xd8"
        + _segment(0xC4, b"\x00" + counts + symbols)
        + _segment(0xC3, struct.pack(">BHHBBBB", 8, SIDE, SIDE, 1, 1, 0x11, 0))
        + _segment(0xDA, bytes([1, 1, 0, 1, 0, 0]))
    )


_HEADER = _jpeg_header()


def _encoder_tables() -> tuple[np.ndarray, np.ndarray]:
    value, bits = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        category = abs(d).bit_length()
        code, length = _CODES[category]
        value[d + 255] = code << category | (d if d >= 0 else d + (1 << category) - 1)
        bits[d + 255] = length + category
    return value, bits


_VALUE, _BITS = _encoder_tables()


def encode_frames(payload: bytes) -> list[bytes]:
    """Lossless JPEGs of consecutive frames; the payload's length is a multiple of FRAME."""
    step = AT_ONCE * FRAME
    return [f for at in range(0, len(payload), step) for f in _encode(payload[at : at + step])]


def _encode(payload: bytes) -> list[bytes]:
    x = np.frombuffer(payload, np.uint8).astype(np.int16).reshape(-1, SIDE, SIDE)
    n = len(x)
    diff = np.empty_like(x)
    diff[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    diff[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    diff[:, 0, 0] = x[:, 0, 0] - 128
    key = diff.reshape(n, FRAME) + 255
    value, bits = _VALUE[key], _BITS[key]
    ends = np.cumsum(bits, axis=1)
    size = (ends[:, -1] + 7) >> 3
    base = np.zeros(n + 1, np.int64)
    np.cumsum(size, out=base[1:])
    start = (ends - bits) + (base[:-1] << 3)[:, None]
    window = (value << (24 - (start & 7) - bits)).ravel()
    at = (start >> 3).ravel()
    total = int(base[-1])
    data = np.zeros(total + 3, np.float64)
    for k in range(3):
        data[k : k + total + 1] += np.bincount(at, weights=(window >> (16 - 8 * k)) & 255, minlength=total + 1)[: total + 1]
    data = data[:total].astype(np.uint8)
    spare = (size << 3) - ends[:, -1]
    data[base[1:] - 1] |= ((1 << spare) - 1).astype(np.uint8)
    full = np.flatnonzero(data == 255)  # 255 is followed by a stuffed 0
    cuts = base + np.searchsorted(full, base)
    raw = np.insert(data, full + 1, 0).tobytes()
    return [_HEADER + raw[a:b] + b"\xff\xd9" for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(frames: list[bytes]) -> bytes:
    n, most = len(frames), max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // FPS, most * FPS, 0, 0x10, n, 0, 1, most, SIDE, SIDE, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, FPS, 0, n, most, 0xFFFFFFFF, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    hdrl = b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    parts, index, offset = [], [], 4
    for f in frames:
        chunk = _chunk(b"00dc", f)
        parts.append(chunk)
        index.append(struct.pack("<4sIII", b"00dc", 0x10, offset, len(f)))
        offset += len(chunk)
    body = b"AVI " + _chunk(b"LIST", hdrl) + _chunk(b"LIST", b"movi" + b"".join(parts)) + _chunk(b"idx1", b"".join(index))
    return _chunk(b"RIFF", body)


def _walk(data: bytes, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while start + 8 <= end:
        name, size = data[start : start + 4], struct.unpack_from("<I", data, start + 4)[0]
        if start + 8 + size > end:
            raise ValueError("a RIFF chunk runs past its parent")
        yield name, start + 8, size
        start += 8 + size + (size & 1)


def parse_avi(data: bytes | None) -> tuple[int, int, float, list[tuple[int, int]]]:
    """Width, height, frames a second and (offset, size) of each frame, from the headers and the idx1 index."""
    if not data or data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    width = height = 0
    rate, movi, index, handler = 0.0, None, None, b""
    for name, at, size in _walk(data, 12, min(len(data), 8 + struct.unpack_from("<I", data, 4)[0])):
        kind = data[at : at + 4]
        if name == b"LIST" and kind == b"hdrl":
            for sub, p, n in _walk(data, at + 4, at + size):
                if sub == b"avih":
                    rate = 1e6 / max(1, struct.unpack_from("<I", data, p)[0])
                    width, height = struct.unpack_from("<II", data, p + 32)
                elif sub == b"LIST" and data[p : p + 4] == b"strl":
                    for inner, q, _ in _walk(data, p + 4, p + n):
                        if inner == b"strh" and data[q : q + 4] == b"vids":
                            handler = data[q + 4 : q + 8]
        elif name == b"LIST" and kind == b"movi":
            movi = (at, size)
        elif name == b"idx1":
            index = (at, size)
    if movi is None or index is None or handler != b"MJPG":
        raise ValueError("no motion JPEG stream with an index")
    frames = []
    for k in range(index[0], index[0] + index[1] - 15, 16):
        name, _, offset, size = struct.unpack_from("<4sIII", data, k)
        if name[2:] not in (b"dc", b"db"):
            continue
        at = offset + movi[0]  # offsets count from the list's type
        if data[at : at + 4] != name:
            at = offset  # or, in some files, from the file's start
        if data[at : at + 4] != name or at + 8 + size > len(data):
            raise ValueError("the index points outside the frames")
        frames.append((at + 8, size))
    return width, height, rate, frames


class _Scan:
    """What the header of a lossless JPEG says, with a table that decodes 16 bits to (length, difference)."""

    def __init__(self, jpeg: bytes):
        at, table, shape = 2, None, None
        if jpeg[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG image")
        while True:
            if jpeg[at : at + 1] != b"\xff" or at + 4 > len(jpeg):
                raise ValueError("broken JPEG header")
            marker, size = jpeg[at + 1], struct.unpack_from(">H", jpeg, at + 2)[0]
            body = jpeg[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xC4:
                table = body
            elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                bits, height, width, parts = struct.unpack_from(">BHHB", body)
                if marker != 0xC3 or bits != 8 or parts != 1:
                    raise ValueError("only baseline JPEG and lossless JPEG of 8 grey bits are decoded")
                shape = (height, width)
            elif marker == 0xDA:
                if body[-3] != 1 or body[-1] != 0:
                    raise ValueError("only predictor 1 is decoded")
                break
        if table is None or shape is None:
            raise ValueError("a JPEG table is missing")
        self.header, self.shape = jpeg[:at], shape
        symbols, k = {}, 17
        for length in range(1, 17):
            for _ in range(table[length]):
                symbols[table[k]] = length
                k += 1
        self.bits, self.diff = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int16)
        for category, (code, length) in _canonical(symbols).items():
            total = length + category
            if total > 16:
                raise ValueError("a code of more than 16 bits with its difference")
            for extra in range(1 << category):
                first = (code << category | extra) << (16 - total)
                d = extra if not category or extra >> (category - 1) else extra - (1 << category) + 1
                self.bits[first : first + (1 << (16 - total))] = total
                self.diff[first : first + (1 << (16 - total))] = d


_scans: dict[bytes, _Scan] = {}


def _scan_of(jpeg: bytes) -> _Scan:
    for header, scan in _scans.items():
        if jpeg.startswith(header):
            return scan
    scan = _Scan(jpeg)
    if len(_scans) > 16:
        _scans.clear()
    _scans[scan.header] = scan
    return scan


def _is_lossless(jpeg: bytes) -> bool:
    at = 2
    while at + 4 <= len(jpeg) and jpeg[at] == 0xFF and jpeg[at + 1] != 0xDA:
        if jpeg[at + 1] == 0xC3:
            return True
        at += 2 + struct.unpack_from(">H", jpeg, at + 2)[0]
    return False


def decode_frames(jpegs: list[bytes]) -> np.ndarray:
    """Samples (frame, row, column) of lossless JPEGs that share one header, or of baseline JPEGs of one size."""
    if not jpegs:
        return np.zeros((0, SIDE, SIDE), np.uint8)
    if not jpegs[0].startswith(_HEADER) and not _is_lossless(jpegs[0]):
        frames = [baseline.decode(j) for j in jpegs]
        if len({f.shape for f in frames}) > 1:
            raise ValueError("frames of different sizes")
        return np.stack(frames)
    return np.concatenate([_decode(jpegs[at : at + AT_ONCE]) for at in range(0, len(jpegs), AT_ONCE)])


def _decode(jpegs: list[bytes]) -> np.ndarray:
    scan = _scan_of(jpegs[0])
    skip = len(scan.header)
    if any(not j.startswith(scan.header) or j[-2:] != b"\xff\xd9" for j in jpegs):
        raise ValueError("frames with different headers, or cut off")
    data = np.frombuffer(b"".join([j[skip:-2] for j in jpegs]) + bytes(8), np.uint8)
    base = np.zeros(len(jpegs) + 1, np.int64)
    np.cumsum([len(j) - skip - 2 for j in jpegs], out=base[1:])
    stuffed = np.flatnonzero((data[:-1] == 255) & (data[1:] == 0)) + 1
    stuffed = stuffed[stuffed < base[-1]]
    base -= np.searchsorted(stuffed, base)
    data = np.delete(data, stuffed).astype(np.uint32)
    words = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    height, width = scan.shape
    out = np.empty((height * width, len(jpegs)), np.int16)
    at, end = base[:-1] << 3, base[1:] << 3
    last = len(words) - 1
    for k in range(height * width):
        code = (words[np.minimum(at >> 3, last)] >> (16 - (at & 7)).astype(np.uint32)) & 0xFFFF
        out[k] = scan.diff[code]
        step = scan.bits[code]
        if not step.all():
            raise ValueError("an unknown code in a frame")
        at = at + step
    if (at > end).any():
        raise ValueError("a frame ends too early")
    x = out.T.reshape(len(jpegs), height, width).astype(np.int64)
    x[:, 0, 0] += 128
    x[:, :, 0] = np.cumsum(x[:, :, 0], axis=1)
    return np.cumsum(x, axis=2).astype(np.uint8)


def padded(text: bytes) -> bytes:
    return text + b"\xff" * (max(1, -(-len(text) // FRAME)) * FRAME - len(text))


def store_batch(payloads: list[bytes]) -> list[bytes]:
    counts = [len(p) // FRAME for p in payloads]
    frames = encode_frames(b"".join(payloads))
    out, at = [], 0
    for n in counts:
        out.append(write_avi(frames[at : at + n]))
        at += n
    return out


def decode_avi(data: bytes | None) -> tuple[np.ndarray, float]:
    """Frames and frames a second of one AVI file."""
    _, _, rate, places = parse_avi(data)
    return decode_frames([data[a : a + n] for a, n in places]), rate


def histograms(frames: np.ndarray) -> np.ndarray:
    n = len(frames)
    flat = (frames.reshape(n, -1) >> 4).astype(np.int64) + (np.arange(n) * BINS)[:, None]
    return np.bincount(flat.ravel(), minlength=n * BINS).reshape(n, BINS)


def cuts_of(hist: np.ndarray) -> list[int]:
    """Frames that begin a new shot: the histogram differs from the one before by more than the recent differences' mean and deviations allow."""
    if len(hist) < 2:
        return []
    d = np.abs(np.diff(hist, axis=0)).sum(axis=1) / (2.0 * max(1, int(hist[0].sum())))
    cuts, recent = [], []
    for k, x in enumerate(d.tolist()):
        limit = LEAST
        if len(recent) >= 2:
            mean = sum(recent) / len(recent)
            limit = max(LEAST, mean + DEVIATIONS * (sum((y - mean) ** 2 for y in recent) / len(recent)) ** 0.5)
        if x > limit:
            cuts.append(k + 1)
            recent = []
        else:
            recent = [*recent[-WINDOW + 1 :], x]
    return cuts


def store_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media (AVI) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, ["text"], BATCH_BYTES):
            raw = [t.encode() for t in b.column("text").to_pylist()]
            media = store_batch([padded(t) for t in raw])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(list(map(len, raw)), pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


READ = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, starts array<int>, frames int, rate double, error string"


def _read_batch(b: pa.RecordBatch) -> Iterator[dict]:
    """Rows of READ; the frames of all the batch's files are decoded together where their headers agree."""
    media = b.column("media").to_pylist()
    parsed: list = []
    for data in media:
        try:
            _, _, rate, places = parse_avi(data)
            parsed.append((rate, [data[a : a + n] for a, n in places]))
        except (ValueError, struct.error) as e:
            parsed.append(str(e))
    try:
        everything = decode_frames([f for p in parsed if not isinstance(p, str) for f in p[1]])
    except (ValueError, struct.error):
        everything = None  # some file differs: one by one below
    at = 0
    for doc, n_bytes, data, p in zip(b.column("doc_id").to_pylist(), b.column("n_bytes").to_pylist(), media, parsed, strict=True):
        row = {"doc_id": doc, "n_bytes": n_bytes, "media_bytes": len(data) if data is not None else None, "media_sha256": hashlib.sha256(data).hexdigest() if data is not None else None}
        try:
            if isinstance(p, str):
                raise ValueError(p)
            rate, jpegs = p
            if everything is None:
                frames = decode_frames(jpegs)
            else:
                frames, at = everything[at : at + len(jpegs)], at + len(jpegs)
        except (ValueError, struct.error) as e:
            yield row | {"error": str(e)}
            continue
        payload = frames.tobytes()
        hist = histograms(frames)
        starts = [0, *cuts_of(hist)] if len(frames) else []
        mean = hist.sum(axis=0)
        row |= {"payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-32:])}
        row |= {"starts": starts, "frames": len(frames), "rate": rate, "error": None}
        yield row | {"feature": f"frames={len(frames)};cuts={','.join(map(str, starts[1:]))};hist={','.join(map(str, mean.tolist()))}"}


_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.int32(), pa.float64(), pa.string()]
_NAMES = [c.split()[0] for c in READ.split(", ")]


def read_media(media: DataFrame) -> DataFrame:
    """Digests, shot starts and features of rows with doc_id, n_bytes and media."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, ["media"], BATCH_BYTES):
            rows = list(_read_batch(b))
            yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in zip(_NAMES, _KINDS, strict=True)], names=_NAMES)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, READ)


def clips(read: DataFrame) -> DataFrame:
    """One row per shot of rows of read_media: doc_id, clip, first_frame, end_frame (exclusive), start_s, end_s."""
    end = F.when(F.col("clip") + 1 < F.size("starts"), F.element_at("starts", F.col("clip") + 2)).otherwise(F.col("frames"))
    return (
        read.where("error is null")
        .select("doc_id", "starts", "frames", "rate", F.posexplode("starts").alias("clip", "first_frame"))
        .select("doc_id", "clip", "first_frame", end.alias("end_frame"), (F.col("first_frame") / F.col("rate")).alias("start_s"), (end / F.col("rate")).alias("end_s"))
    )
