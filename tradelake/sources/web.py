"""Small files of the web for the driver: form posts with retries, a read-through cache, attachments."""

from __future__ import annotations

import gzip
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable

from pyspark.sql import SparkSession

from .. import storage

#: Fields of the tariff service's form.
FORM = {"aplyYy": "", "cntyCd": "KR", "cntyNm": "한국", "hsSgn": "", "compareCrrspndNation": "KR", "sctYear": "", "hstdYear": "", "tabTpcd": "", "manlOrgnTpcd": "", "searchVal": ""}
ATTACHMENT = re.compile(r"""href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>""", re.I | re.S)


def form(year: int, index: dict | None = None, chapter: str = "") -> dict[str, str]:
    """The form of a year's index, or of one of its chapters."""
    index = index or {}
    return FORM | {"aplyYy": str(year), "sctYear": index.get("clip_sct_year") or "", "hstdYear": index.get("clip_hstd_year") or "", "searchVal": chapter}


def post(url: str, data: dict[str, str], timeout: float = 120, retries: int = 3, pause: float = 2, referer: str | None = None) -> bytes:
    """A form's answer; what a retry can't mend, or an empty answer, is an error."""
    request = urllib.request.Request(url, urllib.parse.urlencode(data).encode(), {"Referer": referer} if referer else {})
    for attempt in range(retries + 1):
        try:
            with urllib.request.urlopen(request, timeout=timeout) as got:
                body = got.read()
            if not body:
                raise RuntimeError(f"empty answer from {url}")
            return body
        except urllib.error.HTTPError as error:
            if error.code < 500 and error.code not in (408, 429) or attempt == retries:
                raise
        except OSError:
            if attempt == retries:
                raise
        time.sleep(pause)
    raise AssertionError


def cached(spark: SparkSession, path: str, fetch: Callable[[], bytes], force: bool = False) -> tuple[bytes, bool]:
    """A gzipped file's content, fetched and kept if it isn't there; and whether it was."""
    if not force and storage.exists(spark, path):
        return gzip.decompress(storage.read_bytes(spark, path)), True
    data = fetch()
    storage.write_bytes(spark, path, gzip.compress(data, 6, mtime=0))
    return data, False


def html_text(payload: bytes) -> str:
    """Strictly UTF-8."""
    return payload.decode("utf-8", errors="strict")


def attachments(page: str, url: str, ending: str = ".xlsx") -> list[tuple[str, str]]:
    """(address, label) of a page's links to files of a kind, by address or by label."""
    found = []
    for href, label in ATTACHMENT.findall(page):
        text = " ".join(re.sub(r"<[^>]*>", " ", label).split())
        if href.lower().split("?")[0].endswith(ending) or text.lower().endswith(ending):
            found.append((urllib.parse.urljoin(url, href), text))
    return found


def download(spark: SparkSession, url: str, path: str, timeout: float = 120) -> int:
    """Keep an attachment; returns its bytes."""
    with urllib.request.urlopen(url, timeout=timeout) as got:
        data = got.read()
    storage.write_bytes(spark, path, data)
    return len(data)
