"""JPEG decoding with numpy: sequential and progressive, 8 bits, Huffman coded (ITU-T T.81).

The next 16 bits at every bit position are laid out once by numpy, so a symbol
is one list lookup; coefficients become pixels block by block in matrix
products.
"""

from __future__ import annotations

import struct
from array import array
from functools import lru_cache

import numpy as np

# Order of a block's coefficients in the stream: along the diagonals, in turns up and down.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))

_BASIS = np.cos(np.pi * np.outer(np.arange(8), 2 * np.arange(8) + 1) / 16) * np.where(np.arange(8) == 0, np.sqrt(1 / 8), 0.5)[:, None]


class _Component:
    def __init__(self, name: int, h: int, v: int, table: int):
        self.name, self.h, self.v, self.table = name, h, v, table
        self.wide = self.high = self.own_wide = self.own_high = 0  # blocks a row and rows, with those that fill up the last MCUs and without
        self.coefficients = array("i")
        self.dc = self.ac = None  # lookup tables of the present scan


@lru_cache(64)
def _lookup(sizes: bytes, symbols: bytes) -> list[int]:
    """Of every 16 bits: length of the code they begin with times 256, and its symbol; 0 where there is none."""
    table = np.zeros(1 << 16, np.int64)
    code, at = 0, 0
    for length in range(1, 17):
        for symbol in symbols[at : at + sizes[length - 1]]:
            first = code << (16 - length)
            table[first : first + (1 << (16 - length))] = length << 8 | symbol
            code += 1
        at += sizes[length - 1]
        code <<= 1
    return table.tolist()


class _Bits:
    """Entropy-coded bytes between two markers."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data.replace(b"\xff\x00", b"\xff") + bytes(8), np.uint8).astype(np.int64)
        wide = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
        self.next16 = ((wide[:, None] >> (8 - np.arange(8))) & 0xFFFF).ravel().tolist()
        self.at = 0

    def take(self, n: int) -> int:
        if not n:
            return 0
        value = self.next16[self.at] >> (16 - n)
        self.at += n
        return value

    def symbol(self, table: list[int]) -> int:
        found = table[self.next16[self.at]]
        if not found:
            raise ValueError("no such code")
        self.at += found >> 8
        return found & 255

    def signed(self, n: int) -> int:
        """A number of ``n`` bits, of which those that begin with 0 are negative."""
        value = self.take(n)
        return value if not n or value >> (n - 1) else value - (1 << n) + 1


class _Scan:
    """One scan: which coefficients, which bits of them, and how far a run of ended blocks reaches."""

    def __init__(self, first: int, last: int, high: int, low: int, progressive: bool):
        self.first, self.last, self.high, self.low, self.progressive = first, last, high, low, progressive
        self.ended = 0

    def block(self, bits: _Bits, c: _Component, at: int, before: list[int], k: int) -> None:
        if not self.progressive:
            self._difference(bits, c, at, before, k, 0)
            self._first_ac(bits, c, at, 1, 63, 0)
        elif self.first == 0:
            if self.high:
                c.coefficients[at] |= bits.take(1) << self.low
            else:
                self._difference(bits, c, at, before, k, self.low)
        elif self.high:
            self._more_ac(bits, c, at)
        else:
            self._first_ac(bits, c, at, self.first, self.last, self.low)

    @staticmethod
    def _difference(bits: _Bits, c: _Component, at: int, before: list[int], k: int, low: int) -> None:
        before[k] += bits.signed(bits.symbol(c.dc))
        c.coefficients[at] = before[k] << low

    def _first_ac(self, bits: _Bits, c: _Component, at: int, first: int, last: int, low: int) -> None:
        if self.ended:
            self.ended -= 1
            return
        k, out, table = first, c.coefficients, c.ac
        while k <= last:
            symbol = bits.symbol(table)
            run, size = symbol >> 4, symbol & 15
            if size:
                k += run
                out[at + k] = bits.signed(size) << low
                k += 1
            elif run == 15:
                k += 16
            else:
                self.ended = (1 << run) - 1 + bits.take(run)
                return

    def _more_ac(self, bits: _Bits, c: _Component, at: int) -> None:
        """One further bit of coefficients: of those that aren't 0 a correction, and new ones of one bit."""
        out, k, one = c.coefficients, self.first, 1 << self.low
        if not self.ended:
            while k <= self.last:
                symbol = bits.symbol(c.ac)
                run, size = symbol >> 4, symbol & 15
                value = 0
                if size:
                    value = one if bits.take(1) else -one
                elif run < 15:
                    self.ended = (1 << run) + bits.take(run)
                    break
                while k <= self.last:
                    if out[at + k]:
                        self._correct(bits, out, at + k, one)
                    elif run:
                        run -= 1
                    else:
                        out[at + k] = value
                        k += 1
                        break
                    k += 1
        if self.ended:
            for k in range(k, self.last + 1):
                if out[at + k]:
                    self._correct(bits, out, at + k, one)
            self.ended -= 1

    @staticmethod
    def _correct(bits: _Bits, out: array, at: int, one: int) -> None:
        if bits.take(1) and not abs(out[at]) & one:
            out[at] += one if out[at] > 0 else -one


def _parts(data: bytes, at: int) -> tuple[list[bytes], int]:
    """Entropy-coded bytes from ``at`` on, parted at restart markers, and where the next other marker stands."""
    found, start = [], at
    while True:
        at = data.find(b"\xff", at)
        if at < 0 or at + 1 >= len(data):
            return [*found, data[start:]], len(data)
        mark = data[at + 1]
        if 0xD0 <= mark <= 0xD7:
            found.append(data[start:at])
            start = at + 2
        elif mark not in (0x00, 0xFF):
            return [*found, data[start:at]], at
        at += 1 if mark == 0xFF else 2


def _read_scan(parts: list[bytes], scan: _Scan, chosen: list[_Component], restart: int, columns: int, rows: int) -> None:
    if len(chosen) == 1:  # by itself a component has no blocks that only fill up MCUs
        c = chosen[0]
        units = [[(c, 0, (y * c.wide + x) * 64)] for y in range(c.own_high) for x in range(c.own_wide)]
    else:
        units = [
            [(c, k, ((y * c.v + v) * c.wide + x * c.h + h) * 64) for k, c in enumerate(chosen) for v in range(c.v) for h in range(c.h)]
            for y in range(rows)
            for x in range(columns)
        ]
    step = restart or len(units)
    for part, at in zip(parts, range(0, len(units), step)):
        bits, before, scan.ended = _Bits(part), [0] * len(chosen), 0
        try:
            for unit in units[at : at + step]:
                for c, k, place in unit:
                    scan.block(bits, c, place, before, k)
        except IndexError:  # the data end early: the rest stays as it is
            continue


def _doubled(x: np.ndarray, axis: int) -> np.ndarray:
    """Twice the size along an axis, each new value a quarter of the neighbour's and three quarters of its own."""
    x = np.moveaxis(x, axis, 0)
    low, high = np.concatenate([x[:1], x[:-1]]), np.concatenate([x[1:], x[-1:]])
    out = np.stack([x * 0.75 + low * 0.25, x * 0.75 + high * 0.25], 1).reshape(2 * len(x), *x.shape[1:])
    return np.moveaxis(out, 0, axis)


def _plane(c: _Component, quantum: np.ndarray, width: int, height: int, across: int, down: int) -> np.ndarray:
    blocks = np.zeros((c.wide * c.high, 64))
    blocks[:, ZIGZAG] = np.frombuffer(c.coefficients, np.int32).reshape(-1, 64) * quantum
    pixels = np.clip(np.rint(_BASIS.T @ blocks.reshape(-1, 8, 8) @ _BASIS + 128), 0, 255)
    plane = pixels.reshape(c.high, c.wide, 8, 8).swapaxes(1, 2).reshape(c.high * 8, c.wide * 8)
    plane = plane[: -(-height * c.v // down), : -(-width * c.h // across)]
    for axis, factor in ((0, down // c.v), (1, across // c.h)):
        plane = _doubled(plane, axis) if factor == 2 else plane.repeat(factor, axis)
    return plane[:height, :width]


def decode_jpeg(data: bytes) -> np.ndarray:
    """RGB pixels of a JPEG; ValueError for what isn't one or is coded otherwise.

    Data that end early give the pixels read so far, the others grey, as
    browsers show them.
    """
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    at, quanta, tables, components = 2, {}, {}, []
    width = height = restart = 0
    progressive, adobe, across, down, columns, rows = False, None, 1, 1, 0, 0
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            at += 1
            continue
        mark = data[at + 1]
        if mark == 0xFF:
            at += 1
            continue
        if mark == 0xD9:
            break
        if mark in (0x00, 0x01) or 0xD0 <= mark <= 0xD8:
            at += 2
            continue
        size = struct.unpack(">H", data[at + 2 : at + 4])[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if mark == 0xDB:
            while body:
                wide = body[0] >> 4
                quanta[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.float64)
                body = body[65 + 64 * wide :]
        elif mark == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = _lookup(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif mark in (0xC0, 0xC1, 0xC2):
            depth, height, width, n = struct.unpack(">BHHB", body[:6])
            if depth != 8 or not width or not height:
                raise ValueError("not 8 bits a sample, or without size")
            progressive = mark == 0xC2
            components = [_Component(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            across, down = max(c.h for c in components), max(c.v for c in components)
            columns, rows = -(-width // (8 * across)), -(-height // (8 * down))
            for c in components:
                c.wide, c.high = columns * c.h, rows * c.v
                c.own_wide, c.own_high = -(-(-(-width * c.h // across)) // 8), -(-(-(-height * c.v // down)) // 8)
                c.coefficients = array("i", bytes(4 * 64 * c.wide * c.high))
        elif mark in (0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("neither sequential nor progressive Huffman coding")
        elif mark == 0xDD:
            restart = struct.unpack(">H", body[:2])[0]
        elif mark == 0xEE and body[:5] == b"Adobe" and len(body) >= 12:
            adobe = body[11]
        elif mark == 0xDA:
            chosen = []
            for i in range(body[0]):
                c = next(c for c in components if c.name == body[1 + 2 * i])
                c.dc, c.ac = tables.get(body[2 + 2 * i] >> 4), tables.get(0x10 | body[2 + 2 * i] & 15)
                chosen.append(c)
            first, last, bits = body[1 + 2 * body[0] : 4 + 2 * body[0]]
            parts, at = _parts(data, at)
            _read_scan(parts, _Scan(first, last, bits >> 4, bits & 15, progressive), chosen, restart, columns, rows)
    if not components:
        raise ValueError("no picture")
    planes = np.stack([_plane(c, quanta[c.table], width, height, across, down) for c in components], 2)
    return _rgb(planes, adobe, [c.name for c in components])


def _rgb(planes: np.ndarray, adobe: int | None, names: list[int]) -> np.ndarray:
    n = planes.shape[2]
    if n == 1:
        return np.rint(planes).astype(np.uint8).repeat(3, 2)
    if n not in (3, 4):
        raise ValueError("neither grey nor of three or four colours")
    if adobe if adobe is not None else n == 3 and bytes(names) != b"RGB":
        y, blue, red = planes[..., 0], planes[..., 1] - 128, planes[..., 2] - 128
        rgb = np.stack([y + 1.402 * red, y - 0.344136 * blue - 0.714136 * red, y + 1.772 * blue], 2)
    else:
        rgb = planes[..., :3]
    if n == 4:  # inks, stored inverted
        rgb = rgb * planes[..., 3:] / 255
    return np.clip(np.rint(rgb), 0, 255).astype(np.uint8)


def grey_jpeg(values: list[int], restart: int = 0) -> bytes:
    """A grey JPEG of 8 x 8 blocks of one shade each, row by row of a square: for tests and composed tables.

    With ``restart`` a marker follows every so many blocks.
    """
    side = int(len(values) ** 0.5)
    segment = lambda mark, body: bytes([0xFF, mark]) + struct.pack(">H", len(body) + 2) + body
    head = struct.pack(">BHHB", 8, 8 * side, 8 * side, 1) + bytes([1, 0x11, 0])
    differences = bytes([0] * 3 + [12] + [0] * 12) + bytes(range(12))  # twelve codes of four bits: sizes 0 to 11
    ended = bytes([1] + [0] * 15) + bytes([0])  # one code: the block has nothing more
    out = b"\xff\xd8" + segment(0xDB, bytes([0]) + bytes([8] * 64)) + segment(0xC0, head) + segment(0xC4, b"\x00" + differences) + segment(0xC4, b"\x10" + ended)
    if restart:
        out += segment(0xDD, struct.pack(">H", restart))
    out += segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))
    step = restart or len(values)
    for n, at in enumerate(range(0, len(values), step)):
        before, bits = 0, ""
        for value in values[at : at + step]:
            d = value - 128 - before
            size = abs(d).bit_length()
            bits += f"{size:04b}" + (f"{d if d > 0 else d + (1 << size) - 1:0{size}b}" if size else "") + "0"
            before = value - 128
        bits += "1" * (-len(bits) % 8)
        coded = int(bits, 2).to_bytes(len(bits) // 8).replace(b"\xff", b"\xff\x00")
        out += (bytes([0xFF, 0xD0 + (n - 1) % 8]) if n else b"") + coded
    return out + b"\xff\xd9"
