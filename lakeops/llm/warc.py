"""WARC derivatives: metadata and plain-text conversion records of response records."""

from __future__ import annotations

import hashlib
import re
import uuid
from base64 import b32encode
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import batches

_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc:derivatives")
#: Elements whose content is no text, and elements that end a line.
_HIDDEN = {"script", "style", "template", "noscript", "head"}
_BLOCK = set("address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())


def digest(data: bytes) -> str:
    return "sha1:" + b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """The same parts always give the same id, so a record that is written again does not change."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, '|'.join(parts))}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """The bytes of a WARC/1.1 record."""
    # a line end inside a value would start another header
    lines = ["WARC/1.1", *(f"{k}: {' '.join(v.split())}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[str, list[tuple[str, str]], bytes] | None:
    """Version, headers and block of a record, or None when the bytes are not one whole record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        return None
    headers: list[tuple[str, str]] = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and headers:  # a folded header
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif ":" in line:
            key, _, value = line.partition(":")
            headers.append((key.strip(), value.strip()))
        else:
            return None
    length = get(headers, "Content-Length")
    if length is None or not length.isdigit() or len(rest) < int(length):
        return None
    return lines[0], headers, rest[: int(length)]


def get(headers: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden, self.title, self.in_title = [], 0, [], False

    def handle_starttag(self, tag, attrs):
        self.in_title = tag == "title"
        if tag in _HIDDEN:
            self.hidden += 1
        elif tag == "body":
            self.hidden = 0  # a head left open ends here
        elif tag in _BLOCK:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        self.in_title = False
        if tag in _HIDDEN and self.hidden:
            self.hidden -= 1
        elif tag in _BLOCK:
            self.parts.append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.hidden:
            self.parts.append(data)


def html_text(html: str) -> tuple[str, str]:
    """Title and text of a page: a line for each block, runs of white space as one space, no empty lines."""
    reader = _Text()
    try:
        reader.feed(html)
        reader.close()
        parts = reader.parts
    except (AssertionError, ValueError):  # markup the parser gives up on
        parts = [unescape(re.sub(r"<[^>]*>", "\n", html))]
    lines = (" ".join(line.split()) for line in "".join(parts).split("\n"))
    return " ".join("".join(reader.title).split()), "\n".join(line for line in lines if line)


def response(uri: str, html: str, date: str, key: str) -> bytes:
    """A response record of a fetched page."""
    payload = html.encode("utf-8", "surrogatepass")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id("response", key, uri, digest(payload))),
        ("WARC-Target-URI", uri),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", digest(payload)),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return record(headers, block)


def derive(data: bytes) -> list[dict]:
    """The metadata and the conversion record of a response record; nothing for other records and broken bytes.

    Both refer to the response and repeat its target, date and payload digest. The metadata lists the response's headers, its HTTP
    status and headers, whether its digests hold, and what was taken from it; the conversion is its text.
    """
    parsed = parse(data)
    if parsed is None or get(parsed[1], "WARC-Type") != "response" or not get(parsed[1], "WARC-Record-ID"):
        return []
    _, headers, block = parsed
    source = get(headers, "WARC-Record-ID")
    head, _, payload = block.partition(b"\r\n\r\n")
    http = [line.strip() for line in head.decode("utf-8", "replace").split("\r\n")]
    charset = next((m.group(1) for line in http if (m := re.match(r"(?i)content-type:.*charset=[\"']?([\w-]+)", line))), "utf-8")
    try:
        html = payload.decode(charset, "replace")
    except LookupError:
        html = payload.decode("utf-8", "replace")
    title, text = html_text(html)
    body = text.encode("utf-8", "replace")
    payload_digest, block_digest = get(headers, "WARC-Payload-Digest"), get(headers, "WARC-Block-Digest")
    fields = [*((f"source-{k}", v) for k, v in headers), ("http-status", http[0] if http else "")]
    fields += [(f"http-{k.strip()}", v.strip()) for k, sep, v in (line.partition(":") for line in http[1:]) if sep]
    fields += [
        ("payload-digest-holds", str(payload_digest == digest(payload)).lower() if payload_digest else "absent"),
        ("block-digest-holds", str(block_digest == digest(block)).lower() if block_digest else "absent"),
        ("title", title),
        ("text-characters", str(len(text))),
        ("conversion-id", record_id("conversion", source)),
    ]
    about = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields).encode("utf-8", "replace")
    out = []
    for kind, content, mime in (("metadata", about, "application/warc-fields"), ("conversion", body, "text/plain; charset=utf-8")):
        linked = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", record_id(kind, source)),
            ("WARC-Refers-To", source),
            *((k, v) for k in ("WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest") if (v := get(headers, k))),
            ("WARC-Block-Digest", digest(content)),
            ("Content-Type", mime),
        ]
        if kind == "metadata":
            linked.insert(3, ("WARC-Concurrent-To", record_id("conversion", source)))
        made = record(linked, content)
        out.append({"kind": kind, "record_id": record_id(kind, source), "refers_to": source, "target_uri": get(headers, "WARC-Target-URI"), "source_digest": payload_digest, "block_digest": digest(content), "n_bytes": len(made), "record": made})
    return out


_DERIVED = "kind string, record_id string, refers_to string, target_uri string, source_digest string, block_digest string, n_bytes long, record binary"


def response_records(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(page_id, record) of rows (page_id, url, html). Null urls and pages count as empty; repeated rows give equal records."""

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, 500):
            keys = ["" if pd.isna(p) else str(int(p)) for p in frame["page_id"]]
            yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "record": [response(u, h, date, k) for u, h, k in zip(frame["url"], frame["html"], keys)]})

    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), text("url"), text("html")).mapInPandas(made, "page_id long, record binary")


def derivatives(records: DataFrame) -> DataFrame:
    """For each row (page_id, record) with the bytes of a response record: its metadata and its conversion record.

    A map without a shuffle. Null or broken bytes and records of other types give nothing; repeated rows give equal
    records with the same ids.
    """

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, 500):
            rows = [{"page_id": p, **d} for p, r in zip(frame["page_id"], frame["record"]) if r is not None for d in derive(bytes(r))]
            columns = ["page_id", *(f.split()[0] for f in _DERIVED.split(", "))]
            yield pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "n_bytes": "int64"})

    return records.select(F.col("page_id").cast("long").alias("page_id"), F.col("record").cast("binary").alias("record")).mapInPandas(made, f"page_id long, {_DERIVED}")
