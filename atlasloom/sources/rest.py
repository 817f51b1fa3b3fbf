"""REST sources and the load sink: retrying client, paged search, boundary fetch with a cache, bundle posting.

Cursor paging is sequential by nature, so one task (or the driver) follows a cursor; types, periods and
planned units are what runs in parallel, as partitions of the data sources.
"""

from __future__ import annotations

import hashlib
import json
import os
import random
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE, MOST_PAGES = 1000, 10_000


class Refused(RuntimeError):
    def __init__(self, status: int, body: str):
        super().__init__(f"HTTP {status}: {body[:300]}")
        self.status = status


@dataclass
class Client:
    """GET and POST with a bearer token, a raw header or client credentials, and retries with growing, jittered pauses."""

    server: str
    token: str | None = None
    header: str | None = None
    credentials: tuple[str, str, str] | None = None  # client id, secret, token URL
    retries: int = 3
    timeout: float = 300
    pause: float = 0.5
    _expires: float = field(default=0, init=False)

    def _authorization(self) -> dict[str, str]:
        if self.header:
            return {"Authorization": self.header}
        if self.credentials and time.time() >= self._expires:
            key, secret, url = self.credentials
            form = urllib.parse.urlencode({"grant_type": "client_credentials", "client_id": key, "client_secret": secret}).encode()
            with urllib.request.urlopen(urllib.request.Request(url, form), timeout=self.timeout) as r:
                found = json.load(r)
            self.token, self._expires = found["access_token"], time.time() + 0.9 * float(found.get("expires_in", 300))
        return {"Authorization": f"Bearer {self.token}"} if self.token else {}

    def url(self, path: str, **query: object) -> str:
        full = path if "://" in path else f"{self.server.rstrip('/')}/{path.lstrip('/')}"
        return full + (("&" if "?" in full else "?") + urllib.parse.urlencode({k: v for k, v in query.items() if v is not None}) if query else "")

    def call(self, path: str, body: dict | None = None, **query: object) -> bytes:
        url = self.url(path, **query)
        own = urllib.parse.urlsplit(url).netloc == urllib.parse.urlsplit(self.server).netloc
        for attempt in range(self.retries + 1):
            headers = {"Accept": "application/json"} | (self._authorization() if own else {}) | ({"Content-Type": "application/fhir+json"} if body else {})
            request = urllib.request.Request(url, json.dumps(body).encode() if body else None, headers)
            wait_for = min(30.0, self.pause * 2**attempt) * random.uniform(0.5, 1)
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as r:
                    return r.read()
            except urllib.error.HTTPError as e:
                if attempt == self.retries or (e.code != 429 and e.code < 500):
                    raise Refused(e.code, e.read().decode(errors="replace")) from e
                after = e.headers.get("Retry-After", "")
                wait_for = float(after) if after.isdigit() else wait_for
            except (urllib.error.URLError, TimeoutError, ConnectionError):
                if attempt == self.retries:
                    raise
            time.sleep(wait_for)
        raise AssertionError

    def get(self, path: str, **query: object) -> dict:
        return json.loads(self.call(path, **query))


def search(client: Client, kind: str, since: str | None = None) -> Iterator[tuple[dict | None, str | None]]:
    """(resource, issue) of every entry of a paged search: next links are followed until there is none; a page met twice,
    a 200 that is no Bundle, and more than MOST_PAGES pages are errors."""
    at, seen = client.url(kind, _count=PAGE, _lastUpdated=f"ge{since}" if since else None), set()
    while at:
        if at in seen or len(seen) >= MOST_PAGES:
            raise ValueError(f"paging does not end: {at}")
        seen.add(at)
        page = client.get(at)
        if page.get("resourceType") != "Bundle":
            raise ValueError(f"not a Bundle: {at}")
        for entry in page.get("entry") or []:
            found = entry.get("resource") if isinstance(entry, dict) else None
            usable = isinstance(found, dict) and found.get("id")
            yield (found, None) if usable else (None, "page_resource_skipped")
        links = [x.get("url") for x in page.get("link") or [] if x.get("relation") == "next"]
        at = urllib.parse.urljoin(at, links[0]) if links and links[0] else None


def count(client: Client, kind: str) -> int | None:
    """How many resources the server holds, if it tells."""
    for query in ({"_summary": "count"}, {"_count": 0, "_total": "accurate"}):
        try:
            found = client.get(kind, **query).get("total")
        except Refused:
            continue
        if isinstance(found, int):
            return found
    return None


class _Type(InputPartition):
    def __init__(self, kind: str):
        super().__init__(kind)


class SearchReader(DataSourceReader):
    """One partition for each resource type, as a cursor can only be followed in order."""

    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [_Type(t) for t in self.options["types"].split(",")]

    def read(self, partition: InputPartition):
        own = self.options
        credentials = (own["client_id"], own["client_secret"], own["token_url"]) if own.get("client_id") else None
        client = Client(own["server"], token=own.get("token"), header=own.get("header"), credentials=credentials, retries=int(own.get("retries", 3)))
        for n, (resource, issue) in enumerate(search(client, partition.value, self.options.get("since"))):
            yield partition.value, n, json.dumps(resource, ensure_ascii=False, separators=(",", ":")) if resource else None, issue


class Search(DataSource):
    """spark.read.format("fhir_search").option("server", ...).option("types", "Location,Organization").load()"""

    @classmethod
    def name(cls) -> str:
        return "fhir_search"

    def schema(self) -> str:
        return "type string, seq long, text string, issue string"

    def reader(self, schema) -> SearchReader:
        return SearchReader(self.options)


class Cache:
    """Payloads by the SHA-256 of their URL, with their own hash beside them; a damaged entry counts as a miss."""

    def __init__(self, folder: str):
        self.folder = folder
        os.makedirs(folder, exist_ok=True)

    def _paths(self, url: str) -> tuple[str, str]:
        key = hashlib.sha256(url.encode()).hexdigest()
        return f"{self.folder}/{key}.bin", f"{self.folder}/{key}.meta.json"

    def get(self, url: str) -> bytes | None:
        data, meta = self._paths(url)
        try:
            with open(data, "rb") as a, open(meta) as b:
                raw, note = a.read(), json.load(b)
        except (OSError, ValueError):
            return None
        return raw if note.get("sha256") == hashlib.sha256(raw).hexdigest() else None

    def put(self, url: str, raw: bytes) -> None:
        data, meta = self._paths(url)
        for path, body in ((data, raw), (meta, json.dumps({"url": url, "sha256": hashlib.sha256(raw).hexdigest()}).encode())):
            part = f"{path}.{os.getpid()}-{threading.get_ident()}"
            with open(part, "wb") as f:
                f.write(body)
            os.replace(part, path)


class Broken(RuntimeError):
    """Fetching has failed too often in a row without one success."""


def fetch_all(urls: list[str], client: Client, cache: Cache | None = None, refresh: bool = False, workers: int = 8, breaker: int = 50) -> Iterator[tuple[str, bytes | None, str | None]]:
    """(url, payload, issue) of distinct URLs in their order; a failure takes the cached copy (boundary_stale_from_cache) or none."""
    failures, successes = 0, 0

    def one(url: str) -> tuple[bytes | None, str | None]:
        held = cache.get(url) if cache else None
        if held is not None and not refresh:
            return held, None
        try:
            raw = client.call(url)
        except (Refused, OSError) as e:
            return (held, "boundary_stale_from_cache") if held is not None else (None, f"boundary_fetch_failed: {e}")
        if cache:
            cache.put(url, raw)
        return raw, None

    urls = list(dict.fromkeys(urls))
    with ThreadPoolExecutor(workers) as pool:
        ahead = [pool.submit(one, u) for u in urls[: 2 * workers]]
        for k, url in enumerate(urls):
            raw, issue = ahead[k].result()
            ahead[k] = None
            if k + 2 * workers < len(urls):
                ahead.append(pool.submit(one, urls[k + 2 * workers]))
            failures, successes = (failures + 1, successes) if raw is None else (0, successes + 1)
            if breaker and failures >= breaker and not successes:
                pool.shutdown(cancel_futures=True)
                raise Broken(f"{failures} fetches failed in a row")
            yield url, raw, issue


def transaction(resources: list[dict]) -> dict:
    """A transaction of puts; a known version is only replaced while it is the current one."""
    entries = []
    for r in resources:
        version = (r.get("meta") or {}).get("versionId")
        request = {"method": "PUT", "url": f"{r['resourceType']}/{r['id']}"} | ({"ifMatch": f'W/"{version}"'} if version else {})
        entries.append({"resource": r, "request": request})
    return {"resourceType": "Bundle", "type": "transaction", "entry": entries}


def preflight(statement: dict, created: set[str]) -> list[str]:
    """Warnings for types whose creation by put is not stated; an error where it is ruled out."""
    stated = {r.get("type"): r.get("updateCreate") for rest in statement.get("rest") or [] for r in rest.get("resource") or []}
    if bad := sorted(t for t in created if stated.get(t) is False):
        raise ValueError(f"the server does not create by update: {', '.join(bad)}")
    return [f"{t}: updateCreate is not stated" for t in sorted(created) if stated.get(t) is None]


def conflicts(client: Client, resources: list[dict]) -> list[str]:
    """Of the versioned resources those whose current version differs."""
    out = []
    for r in resources:
        version = (r.get("meta") or {}).get("versionId")
        if version:
            now = (client.get(f"{r['resourceType']}/{r['id']}").get("meta") or {}).get("versionId")
            if now != version:
                out.append(f"{r['resourceType']}/{r['id']}: expected {version}, found {now}")
    return out


def post_all(bundles: dict[int, list[dict]], needs: dict[int, set[int]], post: Callable[[list[dict]], None], workers: int = 1) -> list[int]:
    """Posts bundles, each after those it needs; returns the order in which they ended. The first failure stops the rest."""
    open_, done, running = dict(sorted(bundles.items())), [], {}
    with ThreadPoolExecutor(workers) as pool:
        while open_ or running:
            for n in [n for n in open_ if needs.get(n, set()) <= set(done)][: workers - len(running)]:
                running[pool.submit(post, open_.pop(n))] = n
            if not running:
                raise ValueError(f"bundles wait for one another: {sorted(open_)}")
            for f in wait(running, return_when=FIRST_COMPLETED).done:
                n = running.pop(f)
                f.result()
                done.append(n)
    return done


def post_stream(bundles: Iterator[tuple[int, list[dict]]], needs: dict[int, set[int]], post: Callable[[list[dict]], None], workers: int = 1) -> list[int]:
    """Posts numbered bundles as they come, each after those it needs, which have lower numbers; returns the order in which they ended.

    At most `workers` bundles are held at a time. The first failure stops the rest.
    """
    done, running = [], {}
    with ThreadPoolExecutor(workers) as pool:

        def settle(until: Callable[[], bool]) -> None:
            while not until():
                for f in wait(running, return_when=FIRST_COMPLETED).done:
                    n = running.pop(f)
                    f.result()
                    done.append(n)

        for n, resources in bundles:
            if bad := [k for k in needs.get(n, ()) if k >= n]:
                raise ValueError(f"bundle {n} waits for {bad}")
            settle(lambda n=n: len(running) < workers and not needs.get(n, set()) & set(running.values()))
            running[pool.submit(post, resources)] = n
        settle(lambda: not running)
    return done
