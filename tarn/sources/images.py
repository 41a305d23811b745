"""A data source of image windows: each partition opens its own file and reads its own rows, so that no image bytes are exchanged.

    spark.dataSource.register(ImageWindows)
    spark.read.format("image_windows").option("path", folder).option("rows", 512).load()

gives a row for each window of `rows` rows of each image: path, height, width, channels, dtype, palette, row (its first), n_rows
and pixels (one flat array for each channel). A large file is dealt to several partitions by its size; a partition reads
the header and then its own windows, one at a time. Files are opened through Arrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tarn.sources.codecs import read_header, read_rows

SCHEMA = "path string, height int, width int, channels int, dtype string, palette boolean, row int, n_rows int, pixels array<array<double>>"
_ARROW = pa.schema([
    ("path", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("dtype", pa.string()), ("palette", pa.bool_()),
    ("row", pa.int32()), ("n_rows", pa.int32()), ("pixels", pa.list_(pa.list_(pa.float64()))),
])
SUFFIXES = (".tif", ".tiff", ".png", ".npy", ".jpg", ".jpeg")


def located(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a path or URI; ArrowInvalid where it knows none."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(path).path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def reachable(path: str) -> bool:
    try:
        located(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def open_file(path: str):
    system, name = located(path)
    return system.open_input_file(name)


class Share(InputPartition):
    """Every `of`-th window of a file, from the `part`-th on."""

    def __init__(self, path: str, part: int, of: int) -> None:
        self.path, self.part, self.of = path, part, of


class WindowReader(DataSourceReader):
    def __init__(self, path: str, rows: int, split_bytes: int) -> None:
        self.path, self.rows, self.split_bytes = path, rows, split_bytes

    def partitions(self) -> list[Share]:
        """By names and sizes alone; no file is opened."""
        system, name = located(self.path)
        info = system.get_file_info(name)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(name, recursive=True))
        files = sorted((f for f in found if f.is_file and f.path.lower().endswith(SUFFIXES)), key=lambda f: f.path)
        scheme = self.path.split("://")[0] + "://" if "://" in self.path and not self.path.startswith("file:") else ""
        shares = lambda f: 1 if f.path.lower().endswith((".png", ".jpg", ".jpeg")) else max(1, -(-f.size // self.split_bytes))
        return [Share(scheme + f.path, k, n) for f in files for n in [shares(f)] for k in range(n)]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        with open_file(partition.path) as f:
            h = read_header(f)
            step = max(self.rows // h.step, 1) * h.step  # whole strips or tiles
            for top in range(partition.part * step, h.height, partition.of * step):
                window = read_rows(f, h, top, min(top + step, h.height))
                pixels = [window[:, :, k].astype(np.float64).ravel() for k in range(h.channels)]
                row = [partition.path, h.height, h.width, h.channels, h.dtype.newbyteorder("=").name, h.palette, top, len(window), pixels]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _ARROW.types, strict=True)], schema=_ARROW)


class ImageWindows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "image_windows"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WindowReader:
        return WindowReader(self.options["path"], int(self.options.get("rows", 512)), int(self.options.get("splitBytes", 64 << 20)))
