"""Windows of image files: TIFF (strips and tiles), PNG (palettes too) and .npy are read here, a run of rows at a time; other formats through an optional package.

A file is anything with seek and read. Only the header and the parts that hold the wanted rows are read (a PNG, whose rows
depend on those above, is read up to them).
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import numpy as np


@dataclass(frozen=True)
class Header:
    """What a file holds: rows x width x channels of dtype; `step` rows come from one part of the file. palette: values are indices."""

    kind: str
    height: int
    width: int
    channels: int
    dtype: np.dtype
    step: int
    palette: bool = False
    facts: dict = field(default_factory=dict)


# TIFF: fixed values of the format.
_TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
_WIDTH, _HEIGHT, _BITS, _PACKING, _PHOTOMETRIC, _STRIPS, _SAMPLES, _ROWS, _STRIP_BYTES, _PLANAR, _PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
_TILE_W, _TILE_H, _TILES, _TILE_BYTES, _FORMAT = 322, 323, 324, 325, 339
_PNG = b"\x89PNG\r\n\x1a\n"


def _tiff_header(f: BinaryIO) -> Header:
    f.seek(0)
    start = f.read(16)
    order = "<" if start[:2] == b"II" else ">"
    big = struct.unpack(order + "H", start[2:4])[0] == 43
    f.seek(struct.unpack(order + ("Q" if big else "I"), start[8:16] if big else start[4:8])[0])
    n = struct.unpack(order + ("Q" if big else "H"), f.read(8 if big else 2))[0]
    size, inline = (20, 8) if big else (12, 4)
    raw, tags = f.read(n * size), {}
    for k in range(n):
        entry = raw[k * size : (k + 1) * size]
        tag, kind = struct.unpack(order + "HH", entry[:4])
        count = struct.unpack(order + ("Q" if big else "I"), entry[4 : size - inline])[0]
        if kind not in _TYPES:
            continue
        code = order + _TYPES[kind] * count
        value = entry[size - inline :]
        if struct.calcsize(code) > inline:
            f.seek(struct.unpack(order + ("Q" if big else "I"), value)[0])
            value = f.read(struct.calcsize(code))
        tags[tag] = struct.unpack(code, value[: struct.calcsize(code)])
    one = lambda tag, default: tags.get(tag, (default,))[0]
    bits = one(_BITS, 1)
    if bits not in (8, 16, 32, 64) or len(set(tags.get(_BITS, (bits,)))) > 1:
        raise ValueError(f"TIFF with {bits} bits a sample")
    dtype = np.dtype(order + {1: "u", 2: "i", 3: "f"}[one(_FORMAT, 1)] + str(bits // 8))
    height, width = one(_HEIGHT, 0), one(_WIDTH, 0)
    step = one(_TILE_H, 0) or min(one(_ROWS, height), height)
    return Header("tiff", height, width, one(_SAMPLES, 1), dtype, max(step, 1), one(_PHOTOMETRIC, 1) == 3, {"tags": tags})


def _unpacked(raw: bytes, packing: int, size: int) -> bytes:
    if packing == 1:
        return raw
    if packing in (8, 32946):
        return zlib.decompress(raw)
    if packing == 32773:  # runs of bytes
        out, at = bytearray(), 0
        while at < len(raw) and len(out) < size:
            n = raw[at]
            if n < 128:
                out += raw[at + 1 : at + 2 + n]
                at += n + 2
            else:
                out += raw[at + 1 : at + 2] * (257 - n) if n > 128 else b""
                at += 2 if n > 128 else 1
        return bytes(out)
    if packing == 5:
        return _lzw(raw, size)
    raise ValueError(f"TIFF packing {packing}")


def _lzw(raw: bytes, size: int) -> bytes:
    """The format's variable-width codes, most significant bit first; 256 clears the table, 257 ends."""
    out, table, bits, held, n, last = bytearray(), [], 9, 0, 0, b""
    for byte in raw:
        held, n = (held << 8) | byte, n + 8
        if n < bits:
            continue
        n -= bits
        code, held = held >> n, held & ((1 << n) - 1)
        if code == 257 or len(out) >= size:
            break
        if code == 256:
            table, bits, last = [bytes([k]) for k in range(256)] + [b"", b""], 9, b""
            continue
        own = table[code] if code < len(table) else last + last[:1]
        out += own
        if last:
            table.append(last + own[:1])
        bits, last = 9 + (len(table) >= 511) + (len(table) >= 1023) + (len(table) >= 2047), own
    return bytes(out)


def _undone(block: np.ndarray, predictor: int) -> np.ndarray:
    """block: rows x width x channels, of values that are differences along a row (2)."""
    if predictor == 2:
        return np.cumsum(block, axis=1, dtype=block.dtype.newbyteorder("="))
    if predictor != 1:
        raise ValueError(f"TIFF predictor {predictor}")
    return block


def _tiff_rows(f: BinaryIO, h: Header, top: int, bottom: int) -> np.ndarray:
    tags = h.facts["tags"]
    one = lambda tag, default: tags.get(tag, (default,))[0]
    packing, predictor, planes = one(_PACKING, 1), one(_PREDICTOR, 1), h.channels if one(_PLANAR, 1) == 2 else 1
    inner = 1 if planes > 1 else h.channels
    tiled = _TILES in tags
    tile_w = one(_TILE_W, 0) if tiled else h.width
    places, sizes = (tags[_TILES], tags[_TILE_BYTES]) if tiled else (tags[_STRIPS], tags[_STRIP_BYTES])
    across = -(-h.width // tile_w)
    down = -(-h.height // h.step)
    out = np.empty((bottom - top, h.width, h.channels), dtype=h.dtype.newbyteorder("="))
    for plane in range(planes):
        for band in range(top // h.step, -(-bottom // h.step)):
            rows = h.step if tiled else min(h.step, h.height - band * h.step)
            a, b = max(top, band * h.step), min(bottom, band * h.step + rows, h.height)
            for k in range(across):
                at = (plane * down + band) * across + k
                f.seek(places[at])
                size = rows * tile_w * inner * h.dtype.itemsize
                raw = _unpacked(f.read(sizes[at]), packing, size)
                block = _undone(np.frombuffer(raw, h.dtype, rows * tile_w * inner).reshape(rows, tile_w, inner), predictor)
                left = k * tile_w
                part = block[a - band * h.step : b - band * h.step, : h.width - left]
                out[a - top : b - top, left : left + tile_w, plane : plane + inner if planes > 1 else h.channels] = part
    return out


def _png_header(f: BinaryIO) -> Header:
    f.seek(8)
    facts: dict = {"data": []}
    while True:
        size, name = struct.unpack(">I4s", f.read(8))
        if name == b"IHDR":
            width, height, bits, colour, _, _, interlaced = struct.unpack(">IIBBBBB", f.read(13))
            f.seek(4, io.SEEK_CUR)
            continue
        if name == b"IDAT":
            facts["data"].append((f.tell(), size))
        if name == b"PLTE":
            facts["palette"] = np.frombuffer(f.read(size), np.uint8).reshape(-1, 3)
            f.seek(4, io.SEEK_CUR)
            continue
        if name == b"IEND":
            break
        f.seek(size + 4, io.SEEK_CUR)
    if interlaced:
        raise ValueError("interlaced PNG")
    facts["bits"] = bits
    return Header("png", height, width, {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour], np.dtype(np.uint16 if bits == 16 else np.uint8), 1, colour == 3, facts)


def _png_lines(f: BinaryIO, h: Header) -> Iterator[bytes]:
    """Filtered lines, one after another, unpacked as they come."""
    size = 1 + -(-h.width * h.channels * h.facts["bits"] // 8)
    held, unpack = bytearray(), zlib.decompressobj()
    for place, n in h.facts["data"]:
        f.seek(place)
        held += unpack.decompress(f.read(n))
        while len(held) >= size:
            yield bytes(held[:size])
            del held[:size]


def _png_rows(f: BinaryIO, h: Header, top: int, bottom: int) -> np.ndarray:
    bits = h.facts["bits"]
    back = max(1, h.channels * bits // 8)
    above = np.zeros(-(-h.width * h.channels * bits // 8), dtype=np.uint8)
    out = []
    for y, line in zip(range(bottom), _png_lines(f, h), strict=False):
        how, own = line[0], np.frombuffer(line, np.uint8, offset=1)
        if how == 2:
            own = own + above
        elif how == 1:  # each byte of a pixel goes on from that of the pixel before
            pad = -len(own) % back
            own = np.cumsum(np.append(own, np.zeros(pad, np.uint8)).reshape(-1, back), axis=0, dtype=np.uint8).ravel()[: len(own)]
        elif how in (3, 4):
            done, up = bytearray(back) + bytearray(own.tobytes()), bytes(back) + above.tobytes()
            for i in range(back, len(done)):
                a, b, c = done[i - back], up[i], up[i - back]
                guess = (a + b) // 2 if how == 3 else min((a, b, c), key=lambda v, p=a + b - c: abs(p - v))
                done[i] = (done[i] + guess) & 255
            own = np.frombuffer(bytes(done[back:]), np.uint8)
        above = own
        if y >= top:
            out.append(own)
    rows = np.stack(out)
    if bits == 16:
        rows = rows.view(">u2").astype(np.uint16)
    elif bits < 8:
        rows = np.unpackbits(rows, axis=1).reshape(len(rows), -1, bits) @ (1 << np.arange(bits - 1, -1, -1)).astype(np.uint8)
        if not h.palette:
            rows = rows * (255 // ((1 << bits) - 1))
    return rows[:, : h.width * h.channels].reshape(len(rows), h.width, h.channels)


def _npy_header(f: BinaryIO) -> Header:
    f.seek(0)
    version = np.lib.format.read_magic(f)
    shape, fortran, dtype = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
    if fortran or len(shape) not in (2, 3) or dtype.hasobject:
        raise ValueError(f".npy of shape {shape}, by columns: {fortran}")
    channels = shape[2] if len(shape) == 3 else 1
    return Header("npy", shape[0], shape[1], channels, dtype, 1, facts={"place": f.tell()})


def _npy_rows(f: BinaryIO, h: Header, top: int, bottom: int) -> np.ndarray:
    line = h.width * h.channels * h.dtype.itemsize
    f.seek(h.facts["place"] + top * line)
    return np.frombuffer(f.read((bottom - top) * line), h.dtype).reshape(bottom - top, h.width, h.channels)


def _other_header(f: BinaryIO) -> Header:
    from PIL import Image  # optional

    f.seek(0)
    image = np.asarray(Image.open(f))
    image = image[:, :, None] if image.ndim == 2 else image
    return Header("other", *image.shape, image.dtype, len(image), facts={"image": image})


def read_header(f: BinaryIO) -> Header:
    f.seek(0)
    start = f.read(8)
    if start[:4] in (b"II*\0", b"MM\0*", b"II+\0", b"MM\0+"):
        return _tiff_header(f)
    if start == _PNG:
        return _png_header(f)
    return _npy_header(f) if start[:6] == b"\x93NUMPY" else _other_header(f)


def read_rows(f: BinaryIO, h: Header, top: int = 0, bottom: int | None = None) -> np.ndarray:
    """Rows top to bottom (excluded) as rows x width x channels."""
    bottom = h.height if bottom is None else bottom
    if h.kind == "other":
        return h.facts["image"][top:bottom]
    return {"tiff": _tiff_rows, "png": _png_rows, "npy": _npy_rows}[h.kind](f, h, top, bottom)


def read_image(content: bytes) -> tuple[np.ndarray, bool]:
    """A whole image, rows x width (x channels if it has several), and whether its values are indices of a palette."""
    f = io.BytesIO(content)
    h = read_header(f)
    image = read_rows(f, h)
    return (image[:, :, 0] if h.channels == 1 else image), h.palette
