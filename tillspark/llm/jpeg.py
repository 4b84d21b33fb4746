"""Baseline JPEG images (8-bit sequential DCT, Huffman coded) to the samples of their first component, which is grey or luma.

One interleaved scan with one component or several, sampling factors of 1 to 4, tables of either precision, restart intervals.
Whatever else a file may hold (progressive or arithmetic coding, several scans, a missing table, a cut-off scan) raises ValueError.
"""

from __future__ import annotations

import contextlib
import math
import re
import struct

import numpy as np

_K = np.arange(8)
#: Row u of the transform: the samples of frequency u.
_BASIS = np.where(_K[:, None] == 0, math.sqrt(0.125), 0.5 * np.cos((2 * _K[None, :] + 1) * _K[:, None] * math.pi / 16))
#: Natural places of coefficients in the order in which they are coded: along diagonals, by turns up and down.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))


def huffman(counts: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    """(length, code) -> symbol."""
    table, code, at = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            table[length, code] = symbols[at]
            code, at = code + 1, at + 1
        code <<= 1
    return table


class _Bits:
    """A cursor over a run's bytes: a window of at most some 64 bits, filled from the front, so reading is linear in the bytes."""

    def __init__(self, data: bytes):
        self.data, self.at, self.window, self.held = data, 0, 0, 0

    def _fill(self, n: int) -> None:
        while self.held < n:
            part = self.data[self.at : self.at + 4]
            if not part:
                raise ValueError("a JPEG scan ends too early")
            self.at += len(part)
            self.window = (self.window & ((1 << self.held) - 1)) << 8 * len(part) | int.from_bytes(part, "big")
            self.held += 8 * len(part)

    def take(self, n: int) -> int:
        if self.held < n:
            self._fill(n)
        self.held -= n
        return (self.window >> self.held) & ((1 << n) - 1)

    def symbol(self, table: np.ndarray) -> int:
        """The next symbol, by a table of what each 16 bits begin with: 32 * symbol + length, or 0."""
        if self.held < 16:
            with contextlib.suppress(ValueError):  # near the end there may be fewer
                self._fill(16)
        short = max(0, 16 - self.held)
        found = int(table[(self.window << short >> self.held + short - 16) & 0xFFFF])
        length = found & 31
        if not found or length > self.held:
            raise ValueError("an unknown JPEG code" if not found else "a JPEG scan ends too early")
        self.held -= length
        return found >> 5

    def signed(self, size: int) -> int:
        x = self.take(size) if size else 0
        return x if not size or x >> (size - 1) else x - (1 << size) + 1


def lookup(table: dict[tuple[int, int], int]) -> np.ndarray:
    """What each 16 bits begin with, for a table of huffman()."""
    out = np.zeros(1 << 16, np.int32)
    for (length, code), symbol in table.items():
        out[code << 16 - length : code + 1 << 16 - length] = 32 * symbol + length
    return out


def _header(jpeg: bytes):
    """Frame, tables, components of the scan, restart interval and the scan's start."""
    if jpeg[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG image")
    at, frame, restart = 2, None, 0
    quant: dict[int, np.ndarray] = {}
    tables: dict[int, dict] = {}
    while True:
        if at + 4 > len(jpeg) or jpeg[at] != 0xFF:
            raise ValueError("broken JPEG header")
        marker, size = jpeg[at + 1], struct.unpack_from(">H", jpeg, at + 2)[0]
        body = jpeg[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide, number = body[0] >> 4, body[0] & 15
                quant[number] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = huffman(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            restart = struct.unpack_from(">H", body)[0]
        elif 0xC0 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
            if marker > 0xC1 or body[0] != 8:
                raise ValueError("only baseline and lossless JPEG of 8 bits are decoded")
            height, width, n = struct.unpack_from(">HHB", body, 1)
            frame = (height, width, [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)])
        elif marker == 0xDA:
            picked = {body[1 + 2 * k]: (body[2 + 2 * k] >> 4, 16 | body[2 + 2 * k] & 15) for k in range(body[0])}
            break
    if frame is None or not frame[2] or set(picked) != {c for c, *_ in frame[2]}:
        raise ValueError("only one scan of all components is decoded")
    return frame, quant, tables, picked, restart, at


def decode(jpeg: bytes) -> np.ndarray:
    """Samples (row, column) of the first component."""
    try:
        return _decode(jpeg)
    except (IndexError, KeyError, struct.error) as e:
        raise ValueError(f"a broken JPEG image: {e}") from None


def _decode(jpeg: bytes) -> np.ndarray:
    (height, width, parts), quant, tables, picked, restart, at = _header(jpeg)
    end = jpeg.rfind(b"\xff\xd9")
    if end < at:
        raise ValueError("a JPEG scan ends too early")
    runs = [_Bits(run.replace(b"\xff\x00", b"\xff")) for run in re.split(rb"\xff[\xd0-\xd7]", jpeg[at:end])]
    if len(parts) == 1:  # a scan of one component has its blocks in rows, whatever its factors
        parts = [(parts[0][0], 1, 1, parts[0][3])]
    most_h, most_v = max(h for _, h, _, _ in parts), max(v for _, _, v, _ in parts)
    across, down = -(-width // (8 * most_h)), -(-height // (8 * most_v))
    _, h0, v0, q0 = parts[0]
    blocks = np.zeros((down * v0, across * h0, 64), np.int64)
    last = dict.fromkeys(picked, 0)
    looked = {k: lookup(tables[k]) for k in {k for pair in picked.values() for k in pair}}
    for unit in range(across * down):
        if restart and unit and unit % restart == 0:
            last = dict.fromkeys(picked, 0)
        bits = runs[unit // restart if restart else 0]
        for number, (name, h, v, _) in enumerate(parts):
            dc, ac = (looked[k] for k in picked[name])
            for k in range(h * v):
                block = np.zeros(64, np.int64)
                last[name] += bits.signed(bits.symbol(dc))
                block[0] = last[name]
                place = 1
                while place < 64:
                    code = bits.symbol(ac)
                    run, size = code >> 4, code & 15
                    if not size and run < 15:
                        break
                    place += run
                    block[place] = bits.signed(size)
                    place += 1
                if number == 0:
                    blocks[unit // across * v0 + k // h, unit % across * h0 + k % h] = block
    natural = np.zeros_like(blocks)
    natural[:, :, ZIGZAG] = blocks * quant[q0]
    coded = natural.reshape(*blocks.shape[:2], 8, 8)
    samples = np.einsum("ui,bcuv,vj->bcij", _BASIS, coded, _BASIS) + 128
    plane = np.rint(samples).clip(0, 255).astype(np.uint8).transpose(0, 2, 1, 3).reshape(8 * blocks.shape[0], 8 * blocks.shape[1])
    return plane[: -(-height * v0 // most_v), : -(-width * h0 // most_h)]
