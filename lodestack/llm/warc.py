"""WARC archives: writing records, and the normaliser for monolithic gzip.

A monolithic archive is one gzip member, so that nothing in it can be reached but through all before. The normaliser
inflates such a stream once, writes every record as a member of its own and keeps a sidecar index of their offsets;
readers then seek. Files go to the shared folder under names of their own for each task attempt, and only the files
that a finished attempt has reported are read on, so a lost executor leaves nothing but unused files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, shared_dir, table

#: Bytes of records, before compression, after which a writer starts another archive.
ARCHIVE_BYTES = 24 << 20
CHUNK = 1 << 20
#: Digests that occur several times are broadcast up to this number; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 100_000
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
#: What begins a record inside a stream.
MARK = b"\nWARC/"
#: The longest header that is looked for.
HEAD_BYTES = 1 << 20
#: Bytes of a record up to which its length is believed without a look at what they hold.
HOLD_BYTES = 256 << 20


def digest(payload: bytes) -> str:
    """Base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """A response record, or a revisit record without payload if refers_to is given."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_uri(page)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url)}"] if url else []),
        *([f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_uri(refers_to)}"] if refers_to is not None else []),
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is None:
        block += payload
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode("utf-8", "replace") + END + block + END


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first of several counts."""
    out: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out.setdefault(name.strip().lower(), value.strip())
    return out


def inflated(chunks: Iterator[bytes], damage: list[str]) -> Iterator[bytes]:
    """The content of a gzip stream of one or several members, piece by piece. Zeros after a member are padding. Where
    the stream is cut off, or goes on with something else, it ends and `damage` says so."""
    z, begun = zlib.decompressobj(31), False
    for chunk in chunks:
        while chunk:
            if not begun and not (chunk := chunk.lstrip(b"\0")):
                break
            begun = True
            try:
                piece = z.decompress(chunk, CHUNK)
            except zlib.error:
                damage.append("not gzip")
                return
            if piece:
                yield piece
            chunk = z.unconsumed_tail
            if z.eof:
                chunk, z, begun = z.unused_data, zlib.decompressobj(31), False
    if begun:
        damage.append("cut off")
        if piece := z.flush():
            yield piece


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"[0-9]{1,18}", text) else None


def _end(held: bytearray, at: int) -> int | None:
    """Where the record that begins at `at` ends, by its header; None without a whole header that tells its length."""
    head = held.find(END, at, at + HEAD_BYTES)
    if head < 0 or held[at : at + 5] != b"WARC/":
        return None
    length = _number(fields(bytes(held[at:head])).get("content-length"))
    return None if length is None else head + 4 + length + 4


def _closed(held: bytearray, end: int) -> bool:
    """Whether a record ends there: two line ends, and then another record, a further line end, or nothing."""
    return held[end - 4 : end] == END and (held[end : end + 2] == b"\r\n" or b"WARC/".startswith(held[end : end + 5]))


def _holds_others(held: bytearray) -> bool:
    """Whether a whole record begins within the one that is held."""
    at = held.find(END + b"WARC/")
    while at >= 0:
        end = _end(held, at + 4)
        if end is not None and end + 5 <= len(held) and _closed(held, end):
            return True
        at = held.find(END + b"WARC/", at + 4)
    return False


def records(pieces: Iterator[bytes], damage: list[str]) -> Iterator[bytes]:
    """Whole records, one after the other; only one is held at a time.

    A record is whole if it has a length and two line ends after so many bytes, followed by another record or the end of
    the stream. One that isn't is left out and noted in `damage`, and reading goes on at the next `WARC/` that begins a
    line after its own, so that a wrong length, too long or too short, costs no other record. Headers have at most
    HEAD_BYTES. A length is trusted up to HOLD_BYTES; beyond, only while no whole record begins in what is held.
    """
    held = bytearray()
    pieces = iter(pieces)

    def fill(size: int) -> bool:
        while len(held) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    def go_on() -> bool:
        """Drops all up to the next line that begins a record."""
        at = 1
        while (there := held.find(MARK, at)) < 0:
            del held[: max(0, len(held) - len(MARK) + 1)]
            at = 0
            if not fill(len(held) + 1):
                held.clear()
                return False
        del held[: there + 1]
        return True

    while True:
        while fill(1) and held[0] in b"\r\n":
            del held[0]
        if not held:
            return
        while held.find(END, 0, HEAD_BYTES) < 0 and len(held) < HEAD_BYTES and fill(len(held) + 1):
            pass
        end = _end(held, 0)
        if end is None:
            has_head = held.find(END, 0, HEAD_BYTES) >= 0
            damage.append("no length" if has_head and held.startswith(b"WARC/") else "no header" if has_head or len(held) >= HEAD_BYTES else "unfinished")
        elif end > HOLD_BYTES and fill(HOLD_BYTES) and _holds_others(held):
            damage.append("wrong length")
        elif not fill(end):
            damage.append("wrong length" if held.find(MARK, 1) >= 0 else "unfinished")
        else:
            fill(end + 5)
            if _closed(held, end):
                yield bytes(held[:end])
                del held[:end]
                continue
            damage.append("wrong length")
        if not go_on():
            return


def parsed(raw: bytes) -> dict:
    """page, kind, digest and size of the full payload, refers_to, payload (None for revisits)."""
    head, _, block = raw.partition(END)
    f = fields(head)
    http, _, payload = block[:-4].partition(END)
    revisit = f.get("warc-type") == "revisit"
    size = _number(fields(http).get("content-length", "0")) if revisit else len(payload)
    return {
        "page": _page(f.get("warc-record-id")),
        "kind": f.get("warc-type"),
        "digest": f.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else digest(payload),
        "size": size,
        "refers_to": _page(f.get("warc-refers-to")) if revisit else None,
        "payload": None if revisit else payload,
    }


def normalise(read: Callable[[int], bytes], write: Callable[[bytes], object], level: int = 4, damage: list[str] | None = None) -> list[tuple[int, int, str]]:
    """Writes each record of a gzip stream as a member of its own; (offset, bytes, record id) of each. An empty stream
    has none; what can't be read is left out and noted in `damage`; records of any length are held one at a time."""
    index, at, damage = [], 0, [] if damage is None else damage
    for raw in records(inflated(iter(lambda: read(CHUNK), b""), damage), damage):
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        member = z.compress(raw) + z.flush()
        write(member)
        index.append((at, len(member), fields(raw.partition(END)[0]).get("warc-record-id", "")))
        at += len(member)
    return index


def _attempt() -> str:
    t = TaskContext.get()
    return f"{t.partitionId():05d}-{t.taskAttemptId()}" if t else uuid.uuid4().hex


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    return store, path


def write_monolithic(pages: DataFrame, folder: str) -> DataFrame:
    """Archives of one gzip member each from pages (page, url, html, refers_to); (path, n) of each, in shared storage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _opened(folder)
        made, out, z, size, n = [], None, None, 0, 0
        for b in batches:
            for page, url, html, refers in zip(*(b.column(i) for i in range(4))):
                if out is None:
                    made.append([f"{path}/{_attempt()}-{len(made):04d}.warc.gz", 0])
                    out, z, size = store.open_output_stream(made[-1][0], compression=None), zlib.compressobj(1, zlib.DEFLATED, 31), 0
                raw = record(page.as_py(), url.as_py(), (html.as_py() or "").encode("utf-8", "replace"), refers.as_py())
                out.write(z.compress(raw))
                size, made[-1][1] = size + len(raw), made[-1][1] + 1
                if size >= ARCHIVE_BYTES:
                    out.write(z.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(z.flush())
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], ["path", "n"])

    return cut(pages.select("page", "url", "html", "refers_to").mapInArrow(run, "path string, n long"))


def _each(df: DataFrame, n: int) -> DataFrame:
    """A task for each archive: ranges of their paths, which spread them more evenly than hashes do."""
    return df.repartitionByRange(max(1, n), "path")


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Archives (path) rewritten into `folder`, with a sidecar of JSON lines beside each; of each (path, index, n
    records, damage: what was left out). A damaged archive gives the records that can be read; no archives give none."""
    source = folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _opened(source)
        made = []
        for b in batches:
            for archive in b.column(0).to_pylist():
                name = f"{path}/{_attempt()}-{len(made):04d}.warc.gz"
                with store.open_input_stream(archive, compression=None) as f, store.open_output_stream(name, compression=None) as out:
                    damage: list[str] = []
                    index = normalise(f.read, out.write, damage=damage)
                with store.open_output_stream(f"{name}.index", compression=None) as out:
                    out.write("".join(json.dumps({"offset": o, "length": n, "id": i}) + "\n" for o, n, i in index).encode())
                made.append((name, f"{name}.index", len(index), damage))
        kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(kinds)], ["path", "index", "n", "damage"])

    return cut(_each(archives.select("path"), archives.count()).mapInArrow(run, "path string, index string, n long, damage array<string>"))


READ = "page long, kind string, digest string, size long, refers_to long"


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Records of normalised archives (path, index), each reached by its offset; columns READ. Records of other writers
    that name no page, or give no number as their length, have null there; no archives give no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for archive, sidecar in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = []
                with store.open_input_stream(sidecar, compression=None) as f:
                    index = [json.loads(line) for line in f.read().splitlines()]
                with store.open_input_file(archive) as f:
                    for entry in index:
                        f.seek(entry["offset"])
                        found.append(parsed(zlib.decompress(f.read(entry["length"]), 31)))
                        found[-1].pop("payload")
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in zip(("page", "kind", "digest", "size", "refers_to"), kinds)], ["page", "kind", "digest", "size", "refers_to"])

    return _each(archives.select("path", "index"), archives.count()).mapInArrow(run, READ)


def with_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """page, url, html and refers_to (the page that a revisit refers to, else null) for each row of pages.

    Of rows with equal payloads of at least `least_bytes` bytes those with the largest page id are responses; a row of
    another id, or of none, is a revisit. Rows that share the largest id are all responses, and so are rows whose
    payload occurs with no id at all. Null payloads are empty. Payloads are equal if length and SHA-1 are.
    """
    p = pages.select(F.col(page_id).cast("long").alias("page"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    p = p.withColumns({"sha": F.unhex(F.sha1("html")), "size": F.octet_length("html")})
    several = cut(p.where(F.col("size") >= least_bytes).groupBy("sha", "size").agg(F.max("page").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "size", "first"))
    small = several.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = p.join(F.broadcast(several) if small else several, ["sha", "size"], "left")
    return joined.select("page", "url", "html", F.when(F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> tuple[DataFrame, str]:
    """Normalised archives of pages, in a folder of their own below the shared one; (path, index, n, damage) and the
    folder, which is the result and the caller's to delete; the monolithic archives are deleted once they are read.

    Characters that can't stand in a header are percent-encoded in urls; a null url gives no header; a null page id is
    written as none. An empty table gives no archive. Extra columns are ignored.
    """
    folder = f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    raw = write_monolithic(with_revisits(pages, page_id, url, html, least_bytes), f"{folder}/monolithic")
    made = normalise_archives(raw, f"{folder}/members")
    store, path = fs.FileSystem.from_uri(f"{folder}/monolithic")
    if store.get_file_info(path).type == fs.FileType.Directory:
        store.delete_dir(path)
    return made, f"{folder}/members"


def query(spark, sf_dir: str) -> DataFrame:
    archives, folder = archive(table(spark, sf_dir, "pages"))
    r = read_archives(archives, folder)
    return r.select(F.col("page").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, h, octet_length(encode(h)) AS n, array_to_string(list_transform(string_split(sha1(h), ''), lambda c:
  ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][instr('0123456789abcdef', c)]), '') AS bits FROM p),
f AS (SELECT h, max(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 160, 5), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(bits[i + 1] AS INT) + 8 * CAST(bits[i + 2] AS INT)
    + 4 * CAST(bits[i + 3] AS INT) + 2 * CAST(bits[i + 4] AS INT) + CAST(bits[i + 5] AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM x JOIN f USING (h)
"""
