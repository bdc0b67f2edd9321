"""WARC archives: written as monolithic gzip streams, normalised to one gzip member per record with an offset index, read back.

``write``: rows are dealt over partitions by their key; each task writes its partition's archive as one gzip stream over the whole file
(what a plain ``gzip`` of a WARC file gives), which cannot be entered in the middle. ``normalise`` inflates each such stream once, from
its start, and rewrites every record as a gzip member of its own, with a sidecar index (a Parquet table) of record, offset and
length. ``read`` gives the records of archives of either kind; ``read_at`` inflates single members at indexed offsets.

Archives are files in a shared folder, reached through ``pyarrow.fs`` (``file://``, ``hdfs://``, ``s3://``); a file is written under a name
of the attempt and then renamed, and its content depends on its rows alone, so a task that runs again replaces it by
an equal one. Streams are inflated and records split piece by piece, so memory holds one record, not an archive.

Duplicate payloads: of records with equal payloads of at least ``min_payload`` bytes the one with the largest id is the
response and the others are revisits of it, without a payload of their own.

Defined cases: a NULL payload is an empty payload; a NULL url an empty one; rows that repeat an id and a payload are all
responses if no larger id has that payload; a NULL id is never the target, unless no row with that payload has an id (then each
is a response); an empty table gives no archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import written

PIECE = 1 << 20
LEVEL = 6
MONOLITHIC_LEVEL = 1
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2024-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    """The bare upper-case base32 SHA-1 of WARC payload digests."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key: str, url: str, kind: str, digest: str, refers_to: str | None, length: int, block: bytes) -> bytes:
    head = [VERSION, b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <urn:row:" + key.encode() + b">",
            b"WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").encode(), b"WARC-Date: " + DATE,
            b"WARC-Payload-Digest: sha1:" + digest.encode(), b"X-Payload-Length: " + str(length).encode()]
    if refers_to is not None:
        head += [b"WARC-Refers-To: <urn:row:" + refers_to.encode() + b">", b"WARC-Profile: " + REVISIT_PROFILE]
    head += [b"Content-Type: application/octet-stream", b"Content-Length: " + str(len(block)).encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def inflated(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The content of a gzip file, one member or many, from compressed pieces in order."""
    engine = zlib.decompressobj(31)
    for piece in pieces:
        while piece:
            yield engine.decompress(piece)
            piece = engine.unused_data
            if engine.eof:
                engine = zlib.decompressobj(31)


def records(content: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """``(headers, block, raw)`` of each record in a stream of uncompressed WARC bytes."""
    have = bytearray()

    def need(test: Callable[[], int]) -> int:
        while (n := test()) < 0:
            more = next(content, None)
            if more is None:
                if have.strip():
                    raise ValueError("an archive ends within a record")
                return -1
            have.extend(more)
        return n

    while (head := need(lambda: have.find(b"\r\n\r\n"))) >= 0:
        lines = bytes(have[:head]).decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start, size = head + 4, int(headers["Content-Length"])
        need(lambda: 0 if len(have) >= start + size + 4 else -1)
        if len(have) < start + size + 4:
            raise ValueError("an archive ends within a record")
        yield headers, bytes(have[start:start + size]), bytes(have[:start + size + 4])
        del have[:start + size + 4]


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def _pieces(path: str) -> Iterator[bytes]:
    store, name = _open(path)
    with store.open_input_stream(name, compression=None) as f:
        while piece := f.read(PIECE):
            yield piece


def _save(path: str, pieces: Iterator[bytes]) -> None:
    store, name = _open(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    attempt = f"{name}.attempt-{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(attempt, compression=None) as f:
        for p in pieces:
            f.write(p)
    store.move(attempt, name)


def with_targets(rows: DataFrame, key: str, payload: str, min_payload: int = 0) -> DataFrame:
    """``rows`` with ``refers_to``: the id of the record that an equal payload refers to, NULL for responses. Only ids and
    digests are grouped; a payload that a third of all rows share is aggregated before the shuffle."""
    body = F.coalesce(F.col(payload), F.lit(""))
    mark = F.when(F.octet_length(body) >= min_payload, F.sha2(body, 256))
    marks = rows.select(F.col(key).alias("w_key"), mark.alias("w_mark")).where(F.col("w_mark").isNotNull())
    last = marks.groupBy("w_mark").agg(F.max("w_key").alias("w_last"), F.count(F.lit(1)).alias("w_n")).where("w_n > 1")
    last = written(last.drop("w_n"), "warc_targets")
    return (rows.withColumn("w_mark", mark).join(last, "w_mark", "left").drop("w_mark")
            .withColumn("refers_to", F.when(~F.col(key).eqNullSafe(F.col("w_last")), F.col("w_last"))).drop("w_last"))


def write(rows: DataFrame, folder: str, archives: int, key: Column, url: Column, payload: Column, refers_to: Column) -> DataFrame:
    """Writes ``archives`` monolithic gzip archives at most, one per partition; ``(archive, n_records)`` of each."""
    cells = rows.select(key.cast("string").alias("k"), F.coalesce(url, F.lit("")).alias("u"),
                        F.coalesce(payload, F.lit("")).alias("p"), refers_to.cast("string").alias("r"))

    def stream(first: tuple, rest: Iterator[tuple], n: list[int]) -> Iterator[bytes]:
        engine = zlib.compressobj(MONOLITHIC_LEVEL, zlib.DEFLATED, 31)
        for k, u, p, r in chain([first], rest):
            body = p.encode()
            yield engine.compress(record(k or "", u, "response" if r is None else "revisit", digest_of(body), r, len(body),
                                         body if r is None else b""))
            n[0] += 1
        yield engine.flush()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns], strict=True))
        if (first := next(flat, None)) is not None:
            path, n = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", [0]
            _save(path, stream(first, flat, n))
            yield pa.RecordBatch.from_pydict({"archive": [path], "n_records": pa.array(n, pa.int64())})

    # the rows of a partition and their order are fixed by the key, so a task that runs again writes the same bytes
    dealt = cells.repartition(archives, "k").sortWithinPartitions("k", "r", "p")
    return written(dealt.mapInArrow(run, "archive string, n_records long"), "warc_archives")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites every record of each ``archive`` as its own gzip member, in ``folder`` under the same name; the sidecar index:
    ``(archive, record_id, record_type, offset, length)``, a written table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                new, at, index = f"{folder}/{path.rpartition('/')[2]}", [0], []

                def members(path=path, at=at, index=index) -> Iterator[bytes]:
                    for headers, _, raw in records(inflated(_pieces(path))):
                        engine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = engine.compress(raw) + engine.flush()
                        index.append((headers["WARC-Record-ID"][9:-1], headers["WARC-Type"], at[0], len(member)))
                        at[0] += len(member)
                        yield member

                _save(new, members())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([new] * len(index), pa.string()), *[pa.array([i[k] for i in index], t) for k, t in enumerate(
                        (pa.string(), pa.string(), pa.int64(), pa.int64()))]],
                    names=["archive", "record_id", "record_type", "offset", "length"])

    spread = archives.select("archive").repartition(max(1, archives.count()))
    return written(spread.mapInArrow(run, "archive string, record_id string, record_type string, offset long, length long"),
                   "warc_index")


_ROW = "archive string, record_id string, record_type string, refers_to string, payload_digest string, payload_bytes long, block binary"


def _rows(path: str, found: Iterator[tuple[dict[str, str], bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    for headers, block, _ in found:
        kind, digest, size = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
        if kind == "response" and (digest_of(block) != digest or len(block) != size):
            raise ValueError(f"a damaged record in {path}: {headers['WARC-Record-ID']}")
        refers = headers.get("WARC-Refers-To")
        yield pa.RecordBatch.from_pydict({
            "archive": [path], "record_id": [headers["WARC-Record-ID"][9:-1]], "record_type": [kind],
            "refers_to": pa.array([refers and refers[9:-1]], pa.string()), "payload_digest": [digest],
            "payload_bytes": pa.array([size], pa.int64()), "block": pa.array([block], pa.binary())})


def read(archives: DataFrame) -> DataFrame:
    """Every record of the files in column ``archive``; the digests of full payloads are checked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                yield from _rows(path, records(inflated(_pieces(path))))

    return archives.select("archive").distinct().mapInArrow(run, _ROW)


def read_at(index: DataFrame) -> DataFrame:
    """The records at ``(archive, offset, length)``, each inflated alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_path: dict[str, list[tuple[int, int]]] = {}
            for path, offset, length in zip(*[c.to_pylist() for c in b.columns], strict=True):
                by_path.setdefault(path, []).append((offset, length))
            for path, places in by_path.items():
                store, name = _open(path)
                with store.open_input_file(name) as f:
                    for offset, length in sorted(places):
                        f.seek(offset)
                        yield from _rows(path, records(iter([zlib.decompress(f.read(length), 31)])))

    return index.select("archive", "offset", "length").mapInArrow(run, _ROW)


def round_trip(spark: SparkSession, pages: DataFrame, archive_bytes: int = 32 << 20, min_payload: int = 0) -> DataFrame:
    """``pages (page_id, url, html)`` written, normalised and read back by its index: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to, archive, offset, length``."""
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    archives = max(1, -(-int(size) // archive_bytes))
    folder = shared_dir(spark, "warc")
    aimed = with_targets(pages.select("page_id", "url", "html"), "page_id", "html", min_payload)
    made = write(aimed, f"{folder}/monolithic", archives, F.col("page_id"), F.col("url"), F.col("html"), F.col("refers_to"))
    index = normalise(made, f"{folder}/members")
    back = read_at(index)
    number = lambda c: F.when(F.col(c) != "", F.col(c).cast("long"))
    return back.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       number("refers_to").alias("refers_to"), "archive")
