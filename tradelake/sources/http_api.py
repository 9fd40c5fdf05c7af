"""The statistics service: one request per country and window, its raw answer kept gzipped beside its figures.

``download`` is what a task does for one request.  ``TradeApi`` offers it as a Python data source with a
partition for each request; ``fetch`` runs it over a DataFrame of requests.

    spark.dataSource.register(TradeApi)
    spark.read.format("trade_api").options(url=..., key=..., data_dir=..., requests='[["US","202501","202512"]]').load()
"""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.outcomes import RATE, SPLITTABLE_HTTP, TELLING_HTTP, limit_of
from . import pull

SCHEMA = (
    "country string, window_start string, window_end string, parent_request string, http_status int, api_result_code string, api_result_msg string, parsed boolean, raised boolean, "
    "response_bytes long, gzip_bytes long, sha256 string, elapsed_seconds double, retry_count int, raw_path string, parse_error string, exception string, requested_at string, finished_at string, rate_limit_retries int"
)
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
#: Longest pause between attempts, seconds; bytes that are read at once.
LONGEST_PAUSE, CHUNK = 8, 1 << 20
#: Longest pause after an answer that requests come too fast, and between requests then, seconds.
LONGEST_WAIT, SLOWEST = 30, 10.0


def now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def decoded_key(key: str) -> str:
    """A service key as it is, whether the portal's encoded or decoded form was given."""
    return urllib.parse.unquote(key.strip())


def redacted(text: str, key: str = "") -> str:
    text = re.sub(r"(?i)(serviceKey=)[^&\s]+", r"\1[REDACTED]", text)
    return text.replace(key, "[REDACTED]") if key else text


def read_dotenv(path: str) -> dict[str, str]:
    """NAME=value lines of a file; the environment keeps what it has already."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        pairs = [line.strip().partition("=") for line in f if "=" in line and not line.lstrip().startswith("#")]
    found = {name.strip(): value.strip().strip("\"'") for name, _, value in pairs}
    for name, value in found.items():
        os.environ.setdefault(name, value)
    return found


def raw_path(country: str, start: str, end: str) -> str:
    """Where a request's answer is kept, below the data folder."""
    return f"raw/year={start[:4]}/country={country}/response_{start}-{end}.xml.gz"


def manifest_path(country: str, start: str, end: str) -> str:
    return f"audits/manifests/year={start[:4]}/country={country}/request_{start}-{end}.json"


def store(data_dir: str, name: str, data: bytes) -> str:
    """Write a file on the shared store from an executor; it appears under its name when it is whole."""
    from pyarrow import fs

    system, top = fs.FileSystem.from_uri(data_dir if "://" in data_dir or data_dir.startswith("file:") else f"file://{os.path.abspath(data_dir)}")
    path = f"{top}/{name}"
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(f"{path}.tmp") as out:
        out.write(data)
    system.move(f"{path}.tmp", path)
    return f"{data_dir}/{name}"


def told(body: bytes) -> tuple[str | None, str | None, str | None]:
    """(code, message, parse error) of an answer: the service's header, or else the gateway's envelope; any name spaces."""
    *_, (_, _, _, code, message, error) = pull.parsed_file(body)
    return code, message, error


class Guard:
    """What the tasks of a run tell each other on the shared store: a stop, and how long to wait between requests.

    Each task looks before each request, so a limit met by one ends the others' after the request that they are in.
    """

    def __init__(self, options: dict[str, str]):
        from pyarrow import fs

        self.top, self.name = options["data_dir"], options.get("run")
        self.system, self.path = fs.FileSystem.from_uri(self.top if "://" in self.top or self.top.startswith("file:") else f"file://{os.path.abspath(self.top)}")
        self.delay = float(options.get("delay", 0.15))

    def _read(self, kind: str) -> str | None:
        from pyarrow import fs

        path = f"{self.path}/{self.name}/{kind}"
        if not self.name or self.system.get_file_info(path).type != fs.FileType.File:
            return None
        with self.system.open_input_stream(path) as f:
            return f.read().decode()

    def stopped(self) -> str | None:
        return self._read("stop")

    def stop(self, reason: str) -> None:
        if self.name:
            store(self.top, f"{self.name}/stop", reason.encode())

    def pace(self) -> float:
        """Seconds between a task's requests: the run's own, or what slower answers have made of it."""
        return max(self.delay, float(self._read("pace") or 0))

    def slow_down(self) -> None:
        if self.name:
            store(self.top, f"{self.name}/pace", str(min(SLOWEST, 2 * self.pace())).encode())


def ask(request: dict, options: dict[str, str], guard: Guard) -> dict:
    """Send one request; one that comes too fast waits and is sent again by itself.  Limits that stay stop the run."""
    retries, pause, attempt = int(options.get("rate_limit_retries", 0)), float(options.get("rate_pause", 1)), 0
    while True:
        row = download(request["country"], request["window_start"], request["window_end"], request["parent_request"], options)
        limit = limit_of(*(row[k] for k in ("http_status", "api_result_code", "api_result_msg", "parsed", "raised")))
        if limit != RATE or attempt == retries or guard.stopped():
            break
        attempt += 1
        guard.slow_down()
        time.sleep(min(2**attempt, LONGEST_WAIT) * pause)
    if limit:
        guard.stop(limit)
    return row | {"rate_limit_retries": attempt}


def download(country: str, start: str, end: str, parent: str | None, options: dict[str, str]) -> dict:
    """Send one request until its body is whole or attempts run out, keep the body, and say what came.

    Bodies that tell of quota or rights are kept whatever their HTTP status, and not asked for again.  The key
    is in no result.
    """
    url, key = options["url"], decoded_key(options.get("key", ""))
    retries, timeout, pause = int(options.get("retries", 2)), float(options.get("timeout", 180)), float(options.get("pause", 1))
    query = urllib.parse.urlencode({"serviceKey": key, "strtYymm": start, "endYymm": end, "cntyCd": country})
    row = dict.fromkeys(NAMES) | {"country": country, "window_start": start, "window_end": end, "parent_request": parent, "requested_at": now(), "response_bytes": 0, "gzip_bytes": 0, "raised": True}
    began, body = time.monotonic(), None
    for attempt in range(retries + 1):
        row["retry_count"], row["exception"] = attempt, None
        try:
            try:
                answer = urllib.request.urlopen(f"{url}?{query}", timeout=timeout)
            except urllib.error.HTTPError as error:
                row["http_status"] = error.code
                if error.code not in TELLING_HTTP:
                    raise
                answer = error
            with answer:
                row["http_status"], parts, sha = answer.status, [], hashlib.sha256()
                while part := answer.read(CHUNK):
                    parts.append(part)
                    sha.update(part)
            length = answer.headers.get("Content-Length")
            body = b"".join(parts)
            if length is not None and int(length) > len(body):
                body = None
                raise OSError(f"{length} bytes announced, fewer came")
            row["sha256"], row["raised"] = sha.hexdigest(), False
            break
        except (OSError, ValueError) as error:  # HTTPError is an OSError
            row["exception"] = redacted(f"{type(error).__name__}: {error}", key)
            if isinstance(error, urllib.error.HTTPError) and error.code not in SPLITTABLE_HTTP:
                break
        if attempt < retries:
            time.sleep(min(2**attempt, LONGEST_PAUSE) * pause)
    if body is not None:
        packed = gzip.compress(body, 6, mtime=0)
        row["raw_path"] = store(options["data_dir"], raw_path(country, start, end), packed)
        code, message, error = told(body)
        row |= {"response_bytes": len(body), "gzip_bytes": len(packed), "api_result_code": code, "api_result_msg": message, "parse_error": error, "parsed": error is None}
    return row | {"elapsed_seconds": round(time.monotonic() - began, 3), "finished_at": now()}


def fetch(requests: DataFrame, options: dict[str, str], at_once: int = 4) -> DataFrame:
    """``ask`` over (country, window_start, window_end, parent_request), at most ``at_once`` at a time.

    Requests that a stop leaves unsent have no row.  A task that is lost is run again; its file is written again
    under the same name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guard = Guard(options)
        for batch in batches:
            for r in batch.to_pylist():
                if guard.stopped():
                    return
                yield pa.RecordBatch.from_pylist([ask(r, options, guard)], schema=ARROW)
                time.sleep(guard.pace())

    return requests.select("country", "window_start", "window_end", "parent_request").repartition(at_once).mapInArrow(run, SCHEMA)


ARROW = pa.schema([(x.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[x.split()[1]]) for x in SCHEMA.split(", ")])


class Request(InputPartition):
    def __init__(self, country: str, start: str, end: str):
        self.country, self.start, self.end = country, start, end


class TradeApi(DataSource):
    @classmethod
    def name(cls) -> str:
        return "trade_api"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TradeApiReader:
        return TradeApiReader(self.options)


class TradeApiReader(DataSourceReader):
    def __init__(self, options):
        self.options = {k: options[k] for k in ("url", "key", "data_dir", "retries", "timeout", "pause") if k in options}
        self.requests = json.loads(options.get("requests", "[]"))

    def partitions(self) -> list[Request]:
        return [Request(*r) for r in self.requests]

    def read(self, partition: Request) -> Iterator[tuple]:
        row = download(partition.country, partition.start, partition.end, None, self.options)
        yield tuple(row[n] for n in NAMES)
