"""Interleaved text and media.

HTML is parsed into an ordered array of structs: text, or a reference to media with its caption.  Payloads
live in a table of their own, keyed by the SHA-256 digest of the payload, each stored once by every task
that writes it, as an 8-bit greyscale PNG.  A join on the digest resolves references to whatever the store
(or what was measured from it) holds; positions and captions go through the join and stay aligned.

Pixels are only ever read beside the store: what the join moves is small.  A payload that a third of all
documents refer to is one row on the store's side, and the references' side is a plain shuffle that Spark
splits where it is skewed.

Defined results: null HTML is an empty sequence; a reference without a digest, or one the store lacks, stays
in place with nulls for what it would resolve to; null text is the empty payload; equal texts have equal
payloads, repeated rows too; columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .core import stored

ROW = 192
#: Digests a task remembers, to store a payload once.
REMEMBERED = 200_000
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_REFERENCE = re.compile(r"sha256:([0-9a-f]{64})")


# ---------------------------------------------------------------- sequences
class _Reader(HTMLParser):
    """Text and images in document order.  A figure's caption belongs to its images; otherwise the
    alternative text is the caption.  Scripts and styles are no text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[dict] = []
        self.words: list[str] = []
        self.hidden = 0
        self.figure: list[dict] | None = None
        self.caption: list[str] | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            self.parts.append({"kind": "text", "text": text, "digest": None, "caption": None})
        self.words = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        have = dict(attrs)
        if tag in ("script", "style"):
            self.hidden += 1
        elif tag in ("img", "audio", "video", "source"):
            self.flush()
            found = _REFERENCE.search(have.get("src") or "")
            part = {"kind": "media", "text": None, "digest": found[1] if found else None, "caption": have.get("alt") or have.get("title")}
            self.parts.append(part)
            if self.figure is not None:
                self.figure.append(part)
        elif tag == "figure":
            self.flush()
            self.figure = []
        elif tag == "figcaption":
            self.flush()
            self.caption = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag == "figcaption" and self.caption is not None:
            text = " ".join("".join(self.caption).split())
            for part in self.figure or []:
                part["caption"] = text or part["caption"]
            self.caption = None
        elif tag == "figure":
            self.flush()
            self.figure = None
        elif tag in ("p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "article", "section"):
            self.words.append(" ")

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            (self.words if self.caption is None else self.caption).append(data)


def read_html(html: str | None) -> list[dict]:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.flush()
    return [{"position": i, **part} for i, part in enumerate(reader.parts)]


_PART = pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("digest", pa.string()), ("caption", pa.string())])


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [read_html(x.as_py()) for x in batch.column("html")]
        yield pa.record_batch({"key": batch.column("key"), "parts": pa.array(parts, pa.list_(_PART))})


def sequences(pages: DataFrame, key: str, html: str) -> DataFrame:
    """``key`` and ``parts``, the ordered structs of each page."""
    rows = pages.select(F.col(key).alias("key"), F.col(html).alias("html"))
    kind = rows.schema["key"].dataType.simpleString()
    parts = "array<struct<position:int,kind:string,text:string,digest:string,caption:string>>"
    return rows.mapInArrow(_sequences, f"key {kind}, parts {parts}")


def resolve(pages: DataFrame, store: DataFrame) -> DataFrame:
    """One row per part: ``key``, ``position``, ``kind``, ``text``, ``digest``, ``caption``, and the columns
    that ``store`` has for the digest (distinct there)."""
    parts = pages.select("key", F.explode("parts").alias("part")).select("key", "part.*")
    return parts.join(store, "digest", "left")


def assembled(resolved: DataFrame, *columns: str) -> DataFrame:
    """Parts with what they resolved to, back in one ordered array per key."""
    names = ["position", "kind", "text", "digest", "caption", *columns]
    return resolved.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("parts"))


# ---------------------------------------------------------------- payloads
def payload_of(text: Column, row: int = ROW) -> Column:
    """UTF-8 bytes of a text, filled up with blanks to a positive multiple of ``row``."""
    text = F.coalesce(text, F.lit(""))
    n = F.octet_length(text)
    fill = F.when(n == 0, F.lit(row)).otherwise(F.pmod(-n, F.lit(row)))
    return F.concat(text, F.repeat(F.lit(" "), fill)).cast("binary")


def to_png(payload: bytes, row: int = ROW) -> bytes:
    pixels = np.frombuffer(payload, np.uint8).reshape(-1, row)
    lines = np.zeros((len(pixels), row + 1), np.uint8)
    lines[:, 1:] = pixels

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", row, len(pixels), 8, 0, 0, 0, 0)
    return _SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def from_png(media: bytes) -> np.ndarray:
    """Pixels of a stored image, its checksums verified."""
    if media[:8] != _SIGNATURE:
        raise ValueError("not a stored image")
    at, shape, body = 8, None, []
    while at < len(media):
        n, kind = struct.unpack(">I4s", media[at : at + 8])
        data = media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + data) != struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("a stored image is damaged")
        if kind == b"IHDR":
            shape = struct.unpack(">II", data[:8])
        elif kind == b"IDAT":
            body.append(data)
        at += 12 + n
    width, height = shape
    return np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)[:, 1:]


def feature_of(pixels: np.ndarray) -> str:
    """Size, mean level and a 64-bit hash: which of 8 x 8 fields are lighter than the mean."""
    rows = np.linspace(0, len(pixels), 9).astype(int)
    total = np.concatenate([np.zeros((1, 8), np.int64), np.cumsum(pixels.reshape(len(pixels), 8, -1).sum(axis=2, dtype=np.int64), axis=0)])
    fields = (total[rows[1:]] - total[rows[:-1]]) / np.maximum((rows[1:] - rows[:-1])[:, None] * (pixels.shape[1] // 8), 1)
    mean = float(total[-1].sum()) / pixels.size
    bits = int("".join("1" if x > mean else "0" for x in fields.ravel()), 2)
    return f"{pixels.shape[1]}x{len(pixels)};mean={mean:.3f};hash={bits:016x}"


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[str] = set()
    for batch in batches:
        digests, media, size = [], [], 0
        for digest, payload in zip(batch.column("digest"), batch.column("payload"), strict=True):
            key = digest.as_py()
            if key in seen:
                continue
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen.add(key)
            digests.append(key)
            media.append(to_png(payload.as_py()))
            size += len(media[-1])
            if size > 8 << 20:
                yield pa.record_batch({"digest": pa.array(digests), "media": pa.array(media, pa.binary())})
                digests, media, size = [], [], 0
        yield pa.record_batch({"digest": pa.array(digests, pa.string()), "media": pa.array(media, pa.binary())})


def store(payloads: DataFrame, name: str = "media") -> DataFrame:
    """Writes ``payloads`` (digest, payload) as images to the shared folder.  The table may hold a digest as
    often as tasks met it."""
    return stored(payloads.mapInArrow(_write, "digest string, media binary"), name)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
        for digest, blob in zip(batch.column("digest"), batch.column("media"), strict=True):
            media = blob.as_py()
            pixels = from_png(media)
            payload = pixels.tobytes()
            own = (digest.as_py(), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(pixels))
            for column, x in zip(out.values(), own, strict=True):
                column.append(x)
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))


_MEASURED = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def measured(media: DataFrame) -> DataFrame:
    """Reads stored images back: a small row for each digest."""
    return stored(media.mapInArrow(_measure, _MEASURED).distinct(), "measured")


def op10_media_columns(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), payload_of(F.col("text")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    known = measured(store(rows.select("digest", "payload")))
    # Each document is a page: a heading, its text as one image with a caption, and a closing line.
    page = F.concat(F.lit("<h1>Document</h1><figure><img src=\"sha256:"), F.col("digest"), F.lit("\"><figcaption>text</figcaption></figure><p>end</p>"))
    pages = sequences(rows.select(F.struct("doc_id", "n_bytes").alias("key"), page.alias("html")), "key", "html")
    parts = resolve(pages, known).where("position = 1 and kind = 'media' and caption = 'text'")
    return parts.select("key.doc_id", "key.n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
