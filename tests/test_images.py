import io
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.sources.adapters import get_adapter
from tarn.sources.codecs import read_header, read_image, read_rows
from tarn.sources.images import ImageWindows


def packbits(raw):
    out = bytearray()
    at = 0
    while at < len(raw):
        n = 1
        while at + n < len(raw) and raw[at + n] == raw[at] and n < 128:
            n += 1
        out += bytes([257 - n, raw[at]]) if n > 1 else bytes([0, raw[at]])
        at += n
    return bytes(out) + b"\x80"


def lzw(raw):
    bits, n, codes = 0, 0, []
    table = {bytes([k]): k for k in range(256)}
    size, width, held = 258, 9, b""
    codes.append((256, 9))
    for k in range(len(raw)):
        c = raw[k : k + 1]
        if held + c in table:
            held += c
            continue
        codes.append((table[held], width))
        table[held + c] = size
        size += 1
        if size > (1 << width) - 1 and width < 12:
            width += 1
        if size >= 4094:
            codes.append((256, width))
            table, size, width = {bytes([j]): j for j in range(256)}, 258, 9
        held = c
    if held:
        codes.append((table[held], width))
        size += 1
        if size > (1 << width) - 1 and width < 12:
            width += 1
    codes.append((257, width))
    for code, w in codes:
        bits, n = (bits << w) | code, n + w
    pad = -n % 8
    return (bits << pad).to_bytes((n + pad) // 8, "big")


PACK = {1: bytes, 8: zlib.compress, 32773: packbits, 5: lzw}


def tiff(image, packing=1, tile=None, rows=7, order="<", planar=1, predictor=1, palette=False, big=False):
    """A TIFF of an array, as its specification lays it out."""
    image = image[:, :, None] if image.ndim == 2 else image
    h, w, c = image.shape
    raw = image.astype(image.dtype.newbyteorder(order))
    blocks = []
    for plane in range(c if planar == 2 else 1):
        part = raw[:, :, plane : plane + 1] if planar == 2 else raw
        if tile:
            part = np.pad(part, ((0, -h % tile), (0, -w % tile), (0, 0)))
        down, across = (tile, tile) if tile else (rows, w)
        for y in range(0, part.shape[0], down):
            for x in range(0, part.shape[1], across):
                b = part[y : y + down, x : x + across]
                if predictor == 2:
                    b = np.concatenate([b[:, :1], np.diff(b, axis=1)], axis=1).astype(raw.dtype)
                blocks.append(PACK[packing](np.ascontiguousarray(b).tobytes()))
    kind = {"u": 1, "i": 2, "f": 3}[image.dtype.kind]
    place, size = ("Q", 16) if big else ("I", 4)
    body, at, spots = b"", 16 if big else 8, []
    for b in blocks:
        spots.append(at + len(body))
        body += b
    tags = {256: [w], 257: [h], 258: [image.dtype.itemsize * 8] * c, 259: [packing], 262: [3 if palette else 1], 277: [c], 284: [planar], 317: [predictor], 339: [kind] * c}
    tags |= {322: [tile], 323: [tile], 324: spots, 325: [len(b) for b in blocks]} if tile else {273: spots, 278: [rows], 279: [len(b) for b in blocks]}
    code = 16 if big else 4
    one = struct.calcsize(place)
    directory, extra = b"", b""
    start = at + len(body)
    length = (8 if big else 2) + len(tags) * (20 if big else 12) + (8 if big else 4)
    for tag in sorted(tags):
        values = struct.pack(order + place * len(tags[tag]), *tags[tag])
        directory += struct.pack(order + "HH" + place, tag, code, len(tags[tag]))
        if len(values) <= one:
            directory += values.ljust(one, b"\0")
        else:
            directory += struct.pack(order + place, start + length + len(extra))
            extra += values
    mark = b"II" if order == "<" else b"MM"
    head = mark + (struct.pack(order + "HHHQ", 43, 8, 0, start) if big else struct.pack(order + "HI", 42, start))
    return head + body + struct.pack(order + ("Q" if big else "H"), len(tags)) + directory + struct.pack(order + place, 0) + extra


def png(image, colours=None, bits=8):
    """A PNG of an array (uint8 or uint16), lines filtered in turn by each of the five filters."""
    image = image[:, :, None] if image.ndim == 2 else image
    h, w, c = image.shape
    if bits == 16:
        lines = image.astype(">u2").reshape(h, -1).view(np.uint8)
    elif bits == 8:
        lines = image.astype(np.uint8).reshape(h, -1)
    else:
        digits = (image.reshape(h, -1)[:, :, None] >> np.arange(bits - 1, -1, -1)) & 1
        lines = np.packbits(digits.reshape(h, -1).astype(np.uint8), axis=1)
    back = max(1, c * bits // 8)
    raw, above = b"", np.zeros(lines.shape[1], dtype=int)
    for y in range(h):
        own = lines[y].astype(int)
        left, corner = np.zeros_like(own), np.zeros_like(own)
        left[back:], corner[back:] = own[:-back], above[:-back]
        p = left + above - corner
        near = np.stack([np.abs(p - left), np.abs(p - above), np.abs(p - corner)])
        paeth = np.where((near[0] <= near[1]) & (near[0] <= near[2]), left, np.where(near[1] <= near[2], above, corner))
        guess = [0 * own, left, above, (left + above) // 2, paeth][y % 5]
        raw += bytes([y % 5]) + ((own - guess) % 256).astype(np.uint8).tobytes()
        above = own
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    packed = zlib.compress(raw)
    kind = 3 if colours is not None else {1: 0, 2: 4, 3: 2, 4: 6}[c]
    body = chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, bits, kind, 0, 0, 0)) + chunk(b"tEXt", b"note\0x")
    body += chunk(b"PLTE", np.asarray(colours, np.uint8).tobytes()) if colours is not None else b""
    half = len(packed) // 2
    return b"\x89PNG\r\n\x1a\n" + body + chunk(b"IDAT", packed[:half]) + chunk(b"IDAT", packed[half:]) + chunk(b"IEND", b"")


RNG = np.random.default_rng(4)
IMAGES = {
    "u1": RNG.integers(0, 250, (33, 41), dtype=np.uint8) // 60,
    "u2": RNG.integers(0, 60_000, (20, 31, 3), dtype=np.uint16),
    "i2": RNG.integers(-9000, 9000, (23, 17), dtype=np.int16),
    "f4": RNG.normal(size=(29, 38, 2)).astype(np.float32),
}


@pytest.mark.parametrize("packing", [1, 8, 32773, 5])
@pytest.mark.parametrize("name", sorted(IMAGES))
def test_tiff_equals_its_array(packing, name):
    image = IMAGES[name]
    whole = {k: v for k, v in image.dtype.fields.items()} if image.dtype.fields else None
    assert whole is None
    for more in ({}, {"tile": 16}, {"order": ">"}, {"planar": 2, "rows": 5}, {"planar": 2, "tile": 16}, {"big": True}, {"rows": 64}):
        got, palette = read_image(tiff(image, packing, **more))
        assert got.dtype == image.dtype and np.array_equal(got, image) and not palette
    if image.dtype.kind != "f":
        assert np.array_equal(read_image(tiff(image, packing, predictor=2, tile=16, order=">"))[0], image)
    f = io.BytesIO(tiff(image, packing, tile=16))
    h = read_header(f)
    assert h.step == 16 and np.array_equal(read_rows(f, h, 3, 18).reshape(15, *image.shape[1:]), image[3:18])


def test_a_window_reads_only_its_strips():
    class Counting(io.BytesIO):
        total = 0

        def read(self, *a):
            out = super().read(*a)
            self.total += len(out)
            return out

    image = RNG.normal(size=(1000, 200)).astype(np.float32)
    f = Counting(tiff(image, rows=10))
    h = read_header(f)
    before = f.total
    assert np.array_equal(read_rows(f, h, 495, 505)[:, :, 0], image[495:505]) and f.total - before == 20 * 200 * 4


def test_lzw_over_several_tables():
    image = (np.arange(300 * 300).reshape(300, 300) * 2654435761 % 251).astype(np.uint8)
    assert np.array_equal(read_image(tiff(image, 5, rows=300))[0], image)


def test_png_equals_its_array():
    for c in (1, 2, 3, 4):
        image = RNG.integers(0, 256, (23, 19, c), dtype=np.uint8)
        got, palette = read_image(png(image))
        assert np.array_equal(got, image[:, :, 0] if c == 1 else image) and not palette
    deep = RNG.integers(0, 65536, (11, 7, 3), dtype=np.uint16)
    assert np.array_equal(read_image(png(deep, bits=16))[0], deep)
    for bits in (1, 2, 4, 8):
        index = RNG.integers(0, 2**bits, (21, 13), dtype=np.uint8)
        got, palette = read_image(png(index, RNG.integers(0, 256, (2**bits, 3)), bits))
        assert palette and np.array_equal(got, index)
    grey = RNG.integers(0, 4, (9, 10), dtype=np.uint8)
    assert np.array_equal(read_image(png(grey, bits=2))[0], grey * 85)
    f = io.BytesIO(png(deep, bits=16))
    assert np.array_equal(read_rows(f, read_header(f), 4, 9), deep[4:9])


def test_windows_of_a_folder(spark, tmp_path):
    (tmp_path / "deep er").mkdir()
    files = {"a.tif": tiff(IMAGES["f4"], 8, tile=16), "deep er/b.png": png(IMAGES["u1"]), "c.TIFF": tiff(IMAGES["u2"], rows=4)}
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
    np.save(tmp_path / "d.npy", IMAGES["i2"])
    (tmp_path / "note.txt").write_text("no image")
    spark.dataSource.register(ImageWindows)
    for path in (str(tmp_path), f"file:{tmp_path}".replace(" ", "%20")):
        found = spark.read.format("image_windows").option("path", path).option("rows", 8).option("splitBytes", 1000).load()
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
        want = {"a.tif": IMAGES["f4"], "b.png": IMAGES["u1"], "c.TIFF": IMAGES["u2"], "d.npy": IMAGES["i2"]}
        assert {r.path.split("/")[-1] for r in rows} == set(want)
        for name, image in want.items():
            own = sorted((r for r in rows if r.path.endswith(name)), key=lambda r: r.row)
            image = image[:, :, None] if image.ndim == 2 else image
            assert {(r.height, r.width, r.channels, r.dtype) for r in own} == {(*image.shape, image.dtype.name)}
            whole = np.concatenate([np.stack([np.array(p).reshape(r.n_rows, r.width) for p in r.pixels], axis=2) for r in own])
            assert np.array_equal(whole.astype(image.dtype), image)
    assert found.filter(F.col("path").endswith("c.TIFF")).select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_adapters_read_shipped_formats(spark, tmp_path):
    root = tmp_path / "z" / "train"
    (root / "images").mkdir(parents=True)
    (root / "masks").mkdir()
    (root / "images" / "s.tif").write_bytes(tiff(IMAGES["f4"], 5))
    mask = (RNG.random((29, 38)) < 0.3).astype(np.uint8) * 255
    (root / "masks" / "s.tif").write_bytes(tiff(np.dstack([mask] * 3), 8))
    z = get_adapter("zenodo_s1")(spark, str(tmp_path / "z"))
    plan = z.load(z.discover())._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    s = z.load(z.discover()).collect()[0]
    assert np.allclose(np.array(s.bands[1]).reshape(29, 38), IMAGES["f4"][:, :, 1]) and [m == 1 for m in s.mask] == (mask.ravel() > 0).tolist()
    root = tmp_path / "m" / "train"
    (root / "images").mkdir(parents=True)
    (root / "labels_1D").mkdir()
    index = RNG.integers(0, 5, (33, 41), dtype=np.uint8)
    (root / "images" / "p.png").write_bytes(png(IMAGES["u1"]))
    (root / "labels_1D" / "p.png").write_bytes(png(index, RNG.integers(0, 256, (5, 3)), 4))
    a = get_adapter("mklab")(spark, str(tmp_path / "m"))
    s = a.load(a.discover()).collect()[0]
    assert s.mask == index.ravel().tolist() and np.allclose(s.bands[0], IMAGES["u1"].ravel() / 255.0)
    # RGB labels by their colours.
    (root / "labels_1D" / "p.png").unlink()
    (root / "labels_1D").rmdir()
    (root / "labels").mkdir()
    colours = np.array([(0, 0, 0), (0, 255, 255), (255, 0, 0), (153, 76, 0), (0, 153, 0)], dtype=np.uint8)
    (root / "labels" / "p.png").write_bytes(png(colours[index]))
    assert a.load(a.discover()).collect()[0].mask == index.ravel().tolist()


def test_where_only_spark_can_open_files_rows_carry_the_bytes(spark, tmp_path, monkeypatch):
    from tarn.sources import adapters

    root = tmp_path / "train"
    for d, image in (("images", IMAGES["f4"]), ("masks", np.zeros((29, 38), dtype=np.uint8))):
        (root / d).mkdir(parents=True)
        (root / d / "s.tif").write_bytes(tiff(image))
    monkeypatch.setattr(adapters, "reachable", lambda path: False)
    a = get_adapter("zenodo_s1")(spark, str(tmp_path))
    assert np.allclose(a.load(a.discover()).collect()[0].bands[0], IMAGES["f4"][:, :, 0].ravel())
