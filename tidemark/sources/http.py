"""Polite HTTP: a rate limit, retries with back-off, streamed and resumed downloads.

The transport is a plain function ``(url, headers, timeout) -> (status, body)``, and the streaming
one a context that gives an ``Answer``, so tests and other clients can replace them. Clients are created inside tasks and never pickled.
"""

from __future__ import annotations

import hashlib
import json
import threading
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass, field
from http.client import HTTPException
from pathlib import Path

from pyarrow import fs

# Request interval, attempts, retried status codes, time-out, cache age.
MIN_INTERVAL_SECONDS = 0.125
MAX_ATTEMPTS = 5
RETRIED_STATUS = frozenset({403, 429, 500, 502, 503, 504})
TIMEOUT_SECONDS = 30
TICKER_CACHE_SECONDS = 7 * 24 * 3600
# Where the public filing archive keeps its documents.
TICKERS_URL = "https://www.sec.gov/files/company_tickers.json"
SUBMISSIONS_URL = "https://data.sec.gov/submissions/CIK{cik}.json"
FACTS_URL = "https://data.sec.gov/api/xbrl/companyfacts/CIK{cik}.json"
ARCHIVE_URL = "https://www.sec.gov/Archives/edgar/data/{cik_number}/{accession}/{filename}"
BULK_SUBMISSIONS_URL = (
    "https://www.sec.gov/Archives/edgar/daily-index/bulkdata/submissions.zip"
)
BULK_FACTS_URL = "https://www.sec.gov/Archives/edgar/daily-index/bulkdata/companyfacts.zip"

#: Bytes of a download that are held at once.
BLOCK_BYTES = 1 << 20

Transport = Callable[[str, dict, float], tuple[int, bytes]]


@dataclass
class Answer:
    status: int
    headers: dict[str, str]
    blocks: Iterator[bytes]


Stream = Callable[[str, dict, float], AbstractContextManager[Answer]]


class HttpError(Exception):
    """A request that failed for good."""

    def __init__(self, message: str, url: str, status: int | None = None):
        super().__init__(message)
        self.url, self.status = url, status


def urllib_transport(url: str, headers: dict, timeout: float) -> tuple[int, bytes]:
    request = urllib.request.Request(url, headers=headers)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return response.status, response.read()
    except urllib.error.HTTPError as error:
        return error.code, error.read()


@contextmanager
def urllib_stream(url: str, headers: dict, timeout: float) -> Iterator[Answer]:
    request = urllib.request.Request(url, headers=headers)
    try:
        response = urllib.request.urlopen(request, timeout=timeout)
    except urllib.error.HTTPError as error:
        response = error
    with response:
        yield Answer(response.status, dict(response.headers), iter(lambda: response.read(BLOCK_BYTES), b""))


@dataclass
class HttpClient:
    user_agent: str
    min_interval: float = MIN_INTERVAL_SECONDS
    max_attempts: int = MAX_ATTEMPTS
    transport: Transport = urllib_transport
    stream: Stream | None = None
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)
    _next_start: float = field(default=float("-inf"), repr=False)

    def __post_init__(self) -> None:
        if not self.user_agent:
            raise ValueError("user_agent must not be empty")
        if self.min_interval < 0:
            raise ValueError("min_interval must not be negative")
        if self.max_attempts < 1:
            raise ValueError("max_attempts must be at least 1")

    def __enter__(self) -> HttpClient:
        return self

    def __exit__(self, *exc) -> None:
        return None

    def _pace(self) -> None:
        with self._lock:
            wait = self._next_start - self.clock()
            if wait > 0:
                self.sleep(wait)
            self._next_start = self.clock() + self.min_interval

    def get(self, url: str) -> tuple[int, bytes]:
        """Status and body; retries network errors and the retried codes, doubling the wait."""
        status: int | None = None
        reason = ""
        for attempt in range(self.max_attempts):
            self._pace()
            try:
                status, body = self.transport(
                    url, {"User-Agent": self.user_agent}, TIMEOUT_SECONDS
                )
            except OSError as error:
                reason = repr(error)
            else:
                if 200 <= status < 400:
                    return status, body
                if status not in RETRIED_STATUS:
                    raise HttpError(f"HTTP {status} for {url}", url, status)
                reason = f"HTTP {status}"
            self.sleep(2.0**attempt)
        raise HttpError(f"{url} failed after {self.max_attempts} attempts: {reason}", url, status)

    @contextmanager
    def open(self, url: str, headers: dict) -> Iterator[Answer]:
        """One paced request whose body is read block by block; without a streaming transport of its own,
        a client that was given a transport reads that one's body."""
        self._pace()
        sent = {"User-Agent": self.user_agent, **headers}
        if self.stream is None and self.transport is not urllib_transport:
            status, body = self.transport(url, sent, TIMEOUT_SECONDS)
            yield Answer(status, {}, iter([body]))
        else:
            with (self.stream or urllib_stream)(url, sent, TIMEOUT_SECONDS) as answer:
                yield answer

    def get_bytes(self, url: str) -> bytes:
        return self.get(url)[1]

    def get_text(self, url: str) -> str:
        return self.get_bytes(url).decode("utf-8", errors="replace")

    def get_json(self, url: str):
        return json.loads(self.get_bytes(url))


def _store(path: str | Path) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (shared stores included), and the path in it."""
    text = str(path)
    return fs.FileSystem.from_uri(text if "://" in text else Path(text).absolute().as_uri())


def is_fresh(path: str | Path, max_age_seconds: float | None) -> bool:
    """A file that exists and, with a limit, is younger than it."""
    store, name = _store(path)
    info = store.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        return False
    return max_age_seconds is None or info.mtime is None or time.time() - info.mtime.timestamp() < max_age_seconds


def _lower(headers: dict) -> dict[str, str]:
    return {k.lower(): v for k, v in headers.items()}


def download(client: HttpClient, url: str, path: str | Path, sha256: str | None = None) -> str:
    """Stream ``url`` into ``path``, a local path or the URI of a shared store; returns the SHA-256.

    One block is held at a time. When the connection breaks, the next request asks for the rest by
    range; a server that sends everything again is read past what is there, which must have the same
    content. The file appears under its name only when it is complete: as long as the server said, and
    with the given checksum.
    """
    store, name = _store(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    aside = f"{name}.{uuid.uuid4().hex}.part"
    digest, written, wanted, version, failures = hashlib.sha256(), 0, None, None, 0
    try:
        with store.open_output_stream(aside, compression=None) as out:
            while True:
                before, reason, status = written, "", None
                headers = {"Range": f"bytes={written}-"} if written else {}
                if written and version:
                    headers["If-Range"] = version
                try:
                    with client.open(url, headers) as answer:
                        status, said = answer.status, _lower(answer.headers)
                        if status in RETRIED_STATUS:
                            raise OSError(f"HTTP {status}")
                        if not 200 <= status < 400:
                            raise HttpError(f"HTTP {status} for {url}", url, status)
                        resumed = status == 206
                        if resumed and not said.get("content-range", "").startswith(f"bytes {written}-"):
                            raise HttpError(f"{url}: another range than asked for", url, status)
                        version = said.get("etag") or said.get("last-modified") or version
                        if "content-length" in said:
                            wanted = int(said["content-length"]) + (written if resumed else 0)
                        again, left = hashlib.sha256(), 0 if resumed else written
                        for block in answer.blocks:
                            if left:
                                again.update(block[:left])
                                block, left = block[left:], left - min(left, len(block))
                                if not left and again.digest() != digest.digest():
                                    raise HttpError(f"{url} changed while it was read", url, status)
                            out.write(block)
                            digest.update(block)
                            written += len(block)
                    if left == 0 and (wanted is None or written >= wanted):
                        break
                    reason = f"ended after {written} of {wanted} bytes"
                except HttpError:
                    raise
                except (OSError, HTTPException) as error:
                    reason = repr(error)
                # Only attempts in a row that bring nothing count.
                failures = 1 if written > before else failures + 1
                if failures >= client.max_attempts:
                    raise HttpError(f"{url} failed after {failures} attempts: {reason}", url, status)
                client.sleep(2.0 ** (failures - 1))
        if wanted is not None and written != wanted:
            raise HttpError(f"{url}: {written} bytes instead of {wanted}", url)
        if sha256 is not None and digest.hexdigest() != sha256:
            raise HttpError(f"{url}: checksum {digest.hexdigest()} instead of {sha256}", url)
        store.move(aside, name)
    except BaseException:
        if store.get_file_info(aside).type != fs.FileType.NotFound:
            store.delete_file(aside)
        raise
    return digest.hexdigest()


def cached_download(
    client: HttpClient,
    url: str,
    path: str | Path,
    max_age_seconds: float | None = None,
    force: bool = False,
) -> str | Path:
    """Download to ``path`` unless a fresh copy is there."""
    if force or not is_fresh(path, max_age_seconds):
        download(client, url, path)
    return path


def download_tickers(client: HttpClient, path: str | Path, force: bool = False) -> str | Path:
    return cached_download(client, TICKERS_URL, path, TICKER_CACHE_SECONDS, force)


def download_bulk(client: HttpClient, folder: str | Path, force: bool = False) -> list[str | Path]:
    """The two bulk archives in ``folder``, local or shared; existing files are kept unless forced."""
    return [
        cached_download(client, url, f"{str(folder).rstrip('/')}/{url.rsplit('/', 1)[1]}", force=force)
        for url in (BULK_SUBMISSIONS_URL, BULK_FACTS_URL)
    ]
