"""Downloads and the catalogue data source: resumable transfers, the lock file, paged search."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path
from urllib.parse import urlencode

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, InputPartition, LessThan

CHUNK = 8 << 20
RETRIES = 5
BACKOFF_SECONDS = 5.0
PAGE = 1000
PRODUCT = "Id string, Name string, ContentDate struct<Start:string,End:string>, ContentLength bigint, Online boolean, Attributes array<struct<Name:string,Value:string>>"


@dataclass(frozen=True)
class CatalogueConfig:
    """Endpoints; credentials come from the environment only."""

    catalogue: str = ""
    token_url: str = ""
    download: str = ""
    client_id: str = "public"
    user: str | None = field(default_factory=lambda: os.environ.get("CATALOGUE_USER"))
    password: str | None = field(default_factory=lambda: os.environ.get("CATALOGUE_PASSWORD"))

    @classmethod
    def from_registry(cls, registry: dict, name: str) -> CatalogueConfig:
        entry = registry.get(name, {})
        return cls(**{k: entry[k] for k in ("catalogue", "token_url", "download", "client_id") if k in entry})


def sha256_file(path: str | Path, chunk: int = 1 << 20) -> str:
    running = hashlib.sha256()
    with open(path, "rb") as f:
        while part := f.read(chunk):
            running.update(part)
    return running.hexdigest()


def read_lock(root: str | Path) -> dict:
    path = Path(root) / "lock.json"
    return json.loads(path.read_text()) if path.exists() else {}


def write_lock(root: str | Path, lock: dict) -> None:
    path = Path(root) / "lock.json"
    path.with_suffix(".new").write_text(json.dumps(lock, indent=1, sort_keys=True))
    path.with_suffix(".new").replace(path)


def download(url: str, dest: str | Path, size: int | None = None, opener: Callable = urllib.request.urlopen, headers: dict | None = None, retries: int = RETRIES, backoff: float = BACKOFF_SECONDS, chunk: int = CHUNK) -> Path:
    """Resume from a .part file; a server that ignores the range restarts it; the size is checked; failures back off exponentially."""
    dest = Path(dest)
    part = dest.with_name(dest.name + ".part")
    dest.parent.mkdir(parents=True, exist_ok=True)
    for attempt in range(retries):
        have = part.stat().st_size if part.exists() else 0
        try:
            request = urllib.request.Request(url, headers=(headers or {}) | ({"Range": f"bytes={have}-"} if have else {}))
            with opener(request) as answer:
                resumed = getattr(answer, "status", 200) == 206
                with part.open("ab" if resumed else "wb") as out:
                    shutil.copyfileobj(answer, out, chunk)
            if size is not None and part.stat().st_size != size:
                raise OSError(f"{dest.name}: {part.stat().st_size} bytes, {size} expected")
            part.replace(dest)
            return dest
        except OSError:
            if attempt + 1 == retries:
                raise
            time.sleep(backoff * 2**attempt)
    raise AssertionError


def listing(url: str, opener: Callable = urllib.request.urlopen) -> str:
    """The JSON listing of a record's files."""
    with opener(urllib.request.Request(url)) as answer:
        return answer.read().decode()


FETCHED = "relpath string, url string, size bigint, sha256 string, fetched_at string, status string, problem string"


def fetch_files(plan: DataFrame, root: str, locked: dict[str, str], retries: int = RETRIES, backoff: float = BACKOFF_SECONDS, chunk: int = CHUNK) -> DataFrame:
    """FETCHED for each row of a fetch plan: files are downloaded and checked where the rows are, into `root`, a folder that all tasks share.

    locked: the recorded digest by relpath, for files to verify. A file that fails is a row with a problem, so that the others' work is
    kept; a task that runs again resumes its parts and finds finished files."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for f in frame.itertuples():
                dest = Path(root) / f.relpath
                size = None if pd.isna(f.size_) else int(f.size_)
                digest, status, problem = locked.get(f.relpath), "skipped", None
                try:
                    if not dest.resolve().is_relative_to(Path(root).resolve()):
                        raise OSError(f"{f.relpath} lies outside the folder")
                    if f.action == "download" or not dest.exists():
                        if not (dest.exists() and dest.stat().st_size == size):
                            download(f.url, dest, size, retries=retries, backoff=backoff, chunk=chunk)
                        digest, status = sha256_file(dest), "downloaded"
                    elif f.action == "verify":
                        status = "verified"
                        if sha256_file(dest) != digest:
                            raise OSError(f"{dest} differs from its recorded sha256: delete it and fetch again")
                except OSError as e:
                    status, problem = "failed", str(e)
                now = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
                rows.append((f.relpath, f.url, dest.stat().st_size if dest.exists() else None, digest, now, status, problem))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FETCHED.split(", ")]).astype({"size": "Int64"})

    return plan.withColumnRenamed("size", "size_").mapInPandas(work, FETCHED)


class TokenClient:
    """An access token that is renewed `margin` seconds before it ends."""

    def __init__(self, config: CatalogueConfig, post: Callable[[str, bytes], dict], clock: Callable[[], float] = time.time, margin: float = 30.0) -> None:
        self.config, self.post, self.clock, self.margin = config, post, clock, margin
        self._token, self._until = "", 0.0

    def token(self) -> str:
        if self.clock() >= self._until - self.margin:
            if not (self.config.user and self.config.password):
                raise PermissionError("catalogue credentials are not set")
            form = {"grant_type": "password", "client_id": self.config.client_id, "username": self.config.user, "password": self.config.password}
            got = self.post(self.config.token_url, urlencode(form).encode())
            self._token, self._until = got["access_token"], self.clock() + float(got.get("expires_in", 600))
        return self._token

    def product(self, product_id: str, dest: str | Path, **options) -> Path:
        return download(f"{self.config.download}({product_id})/$value", dest, headers={"Authorization": f"Bearer {self.token()}"}, **options)


class CatalogueSource(DataSource):
    """spark.read.format("catalogue").option("url", ...).option("filter", odata).option("top", 100): a paged product search.

    Equality on Id and strict bounds on Name are pushed into the query; pages follow nextLink until `top` rows."""

    @classmethod
    def name(cls) -> str:
        return "catalogue"

    def schema(self) -> str:
        return PRODUCT

    def reader(self, schema) -> DataSourceReader:
        return _CatalogueReader(self.options)


class _CatalogueReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.url, self.top = options["url"], int(options.get("top", 100))
        self.order, self.clauses = options.get("orderBy", "ContentDate/Start desc"), [c for c in [options.get("filter")] if c]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            sign = {EqualTo: "eq", GreaterThan: "gt", LessThan: "lt"}.get(type(f))
            if sign and f.attribute in (("Id",), ("Name",)) and isinstance(f.value, str):
                quoted = f.value.replace("'", "''")
                self.clauses.append(f"{f.attribute[0]} {sign} '{quoted}'")
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        query = {"$top": min(self.top, PAGE), "$orderby": self.order, "$expand": "Attributes"} | ({"$filter": " and ".join(self.clauses)} if self.clauses else {})
        url, left = f"{self.url}?{urlencode(query)}", self.top
        while url and left > 0:
            with urllib.request.urlopen(url) as answer:
                page = json.load(answer)
            for p in page.get("value", [])[:left]:
                left -= 1
                date = p.get("ContentDate") or {}
                yield p.get("Id"), p.get("Name"), (date.get("Start"), date.get("End")), p.get("ContentLength"), p.get("Online"), [(a.get("Name"), str(a.get("Value"))) for a in p.get("Attributes") or []]
            url = page.get("@odata.nextLink")
