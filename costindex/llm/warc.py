"""WARC records in ZIP archives: a Spark writer and a range reader.

An archive is a ZIP file in the usual web-archive layout, its members stored,
not compressed: ``archive/data.warc.gz`` (every WARC record is a gzip member of
its own), ``indexes/index.cdx`` (sorted lines: sort key, time, JSON with file
name, offset and length) and ``datapackage.json`` (the members with their sizes
and digests).

Writing: the payload that several pages share (equal SHA-1, at least
``MIN_REVISIT`` bytes) is written once, as the response of the largest page id;
the others are revisit records that refer to it.  Each task streams its rows
into archives of bounded size under a shared folder and returns their paths;
only the paths of tasks that succeeded reach the manifest, so files left by a
lost attempt are never read.

Reading: the end of the file gives the central directory (ZIP64 where used), the
directory gives the stored members, the indexes give the records, and each block
of neighbouring records is read by its byte range.  Nothing is extracted.
Payload digests are checked against the records.  Archives of other writers are
read alike: any number of data members (``.warc.gz`` or ``.warc``), any number of
indexes (also gzip, or compressed in the ZIP), records listed twice read once; a
data member that no index names is read as one range from its start to its end.
Responses, revisits and resources are returned, other record types are not.

The archives are reached with ``pyarrow.fs``, so the shared folder may be a
mounted path or any store it knows by URI.

Defined results: a null html is an empty payload; pages below ``MIN_REVISIT`` are
all responses; pages without an id never become the response of others and
refer to it like others; rows that repeat the largest id are all responses;
null urls are written as ``about:blank``; an empty table gives no archive and no
rows.  A very long html is one record, and a task holds one record at a time
beside a block of ``RANGE_BYTES``.  Only the three named columns are read, so other
columns may have any name.  Records of other writers have a null page_id; a data
member compressed in the ZIP, or one an index names but the ZIP has not, is an error.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from costindex.llm.common import partitions, stage, text_or_empty
from costindex.session import shared_root

MIN_REVISIT = 1000
#: An archive is closed after so many bytes or records.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 256 << 20, 100_000
#: Neighbouring records are read together up to so many bytes.
RANGE_BYTES = 1 << 20
# Names in the archive layout.
DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdx", "datapackage.json"
DATA_ENDINGS, INDEX_ENDINGS = (".warc.gz", ".warc"), (".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz")
RECORD_TYPES = ("response", "revisit", "resource")
UNDATED = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "record_id string, refers_to_record string, payload binary")


def open_store(uri: str):
    """(file system, path) of a URI or plain path."""
    from pyarrow import fs
    if re.match(r"file:/(?!/)", uri):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


# ---- records ---------------------------------------------------------------------

def _page_urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _urn_page(urn: str | None) -> int | None:
    own = re.fullmatch(r"<urn:x-page:(-?\d+)>", urn or "")
    return int(own.group(1)) if own else None


def _target(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else "about:blank"


def sort_key(url: str) -> str:
    """The index key of a target: host labels from the last to the first, port, path and query, in lower case."""
    try:
        u = urlsplit(url)
        host, port = u.hostname, u.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    labels = ",".join(reversed(host.split(".")))
    return f"{labels}{f':{port}' if port else ''}){u.path or '/'}{'?' + u.query if u.query else ''}".lower()


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = UNDATED) -> bytes:
    """One gzip member with a response or revisit record."""
    target = _target(url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    labelled = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_page_urn(page_id)}",
             f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{labelled}",
             "Content-Type: application/http; msgtype=response"]
    block = http
    if refers_to is None:
        block += payload
    else:
        lines += [f"WARC-Refers-To: {_page_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _headers(raw: bytes) -> dict[str, str]:
    pairs = (x.split(":", 1) for x in raw.decode("utf-8").split("\r\n")[1:] if ":" in x)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _unchunked(body: bytes) -> bytes | None:
    """The body without chunk marks; None when it is not in whole chunks."""
    parts, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return None
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(parts)
        if at + n > len(body):
            return None
        parts.append(body[at:at + n])
        at += n + 2
    return None


def _sha1_label(label: str | None) -> str | None:
    """The hex digest of a SHA-1 label in base 32 or hex; None for no label or another algorithm."""
    kind, _, value = (label or "").partition(":")
    if kind.lower() != "sha1":
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def parse_record(raw: bytes) -> dict | None:
    """A record's page, url, payload size and digest, type, reference and payload (None in a revisit).

    None for records of other types than ``RECORD_TYPES``.  The payload of a
    response in chunks is what the chunks hold; a SHA-1 label must fit that or the
    body as stored.
    """
    head, mark, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/") or not mark:
        raise ValueError("not a WARC record")
    h = _headers(head)
    kind, name = h.get("warc-type"), h.get("warc-record-id")
    if kind not in RECORD_TYPES:
        return None
    length = int(h["content-length"])
    if len(rest) < length:
        raise ValueError(f"{name}: the record is cut off")
    body, http = rest[:length], {}
    if h.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
        lines, _, body = body.partition(b"\r\n\r\n")
        http = _headers(lines)
    digest = _sha1_label(h.get("warc-payload-digest"))
    if kind == "revisit":
        size = http.get("content-length", "")
        payload, size = None, int(size) if size.isdigit() else None
    else:
        whole = _unchunked(body) if "chunked" in http.get("transfer-encoding", "").lower() else None
        payload = body if whole is None else whole
        found, size = hashlib.sha1(payload).hexdigest(), len(payload)
        if digest not in (None, found, hashlib.sha1(body).hexdigest() if whole is not None else found):
            raise ValueError(f"{name}: the payload does not match its digest")
        digest = found
    return {"page_id": _urn_page(name), "url": h.get("warc-target-uri", "").removeprefix("<").removesuffix(">") or None,
            "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": _urn_page(h.get("warc-refers-to")),
            "record_id": name, "refers_to_record": h.get("warc-refers-to"), "payload": payload}


def _chunks(f, at: int, length: int):
    """The bytes of a range, ``RANGE_BYTES`` at a time."""
    f.seek(at)
    while length:
        data = f.read(min(length, RANGE_BYTES))
        if not data:
            raise ValueError("the archive is cut off")
        length -= len(data)
        yield data


def _members(chunks):
    """The uncompressed gzip members of a stream, one after another."""
    z, parts = None, []
    for data in chunks:
        while data:
            z = z or zlib.decompressobj(31)
            parts.append(z.decompress(data))
            data = z.unused_data
            if z.eof:
                yield b"".join(parts)
                z, parts = None, []
    if z is not None:
        raise ValueError("a record is cut off")


def split_members(data: bytes):
    """The uncompressed gzip members of ``data``, one after another."""
    return _members([data])


def split_records(chunks):
    """The WARC records of an uncompressed stream, by their content lengths."""
    held, need = bytearray(), 0
    for data in chunks:
        held += data
        at = 0
        while True:
            if not need:
                while at < len(held) and held[at] in b"\r\n":
                    at += 1
                end = held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                length = _headers(bytes(held[at:end])).get("content-length")
                if not held.startswith(b"WARC/", at) or length is None:
                    raise ValueError("not a WARC record")
                need = end + 4 - at + int(length)
            if len(held) - at < need:
                break
            yield bytes(held[at:at + need])
            at += need
            need = 0
        del held[:at]
    if need or held:
        raise ValueError("a record is cut off")


def records_of(f, at: int, length: int, packed: bool):
    """The records in a byte range of an open file; a gzip member may hold several."""
    if not packed:
        yield from split_records(_chunks(f, at, length))
        return
    for member in _members(_chunks(f, at, length)):
        yield from split_records([member])


# ---- ZIP directory -----------------------------------------------------------------

def zip_members(read, size: int) -> dict[str, tuple[int, int]]:
    """Stored members of a ZIP file: name -> (offset of its data, length).  ``read(offset, length)`` gets a byte range.

    Compressed or encrypted members are left out, as their bytes cannot be read by range.
    """
    return {name: (at, length) for name, (at, length, method) in zip_directory(read, size).items() if method == 0}


def zip_directory(read, size: int) -> dict[str, tuple[int, int, int]]:
    """All members: name -> (offset of its data, length there, method: 0 stored, 8 deflated, -1 encrypted).

    Sizes and offsets of 0xFFFFFFFF are taken from the ZIP64 records.
    """
    tail_at = max(0, size - (22 + 65535 + 20))
    tail = read(tail_at, size - tail_at)
    end = len(tail)
    while True:
        end = tail.rfind(b"PK\x05\x06", 0, end)
        if end < 0:
            raise ValueError("no end of central directory")
        if len(tail) - end >= 22 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
    count, cd_size, cd_at = struct.unpack_from("<HII", tail, end + 10)
    directory_end = tail_at + end
    if end >= 20 and tail[end - 20:end - 16] == b"PK\x06\x07":
        record_at, = struct.unpack_from("<Q", tail, end - 12)
        for record_at in (record_at, directory_end - 20 - 56):  # the second: with bytes before the archive proper
            record = read(record_at, 56)
            if record[:4] == b"PK\x06\x06":
                break
        else:
            raise ValueError("no ZIP64 end of central directory")
        count, cd_size, cd_at = struct.unpack_from("<QQQ", record, 32)
        directory_end = record_at
    shift = directory_end - cd_size - cd_at  # bytes before the archive proper
    if shift < 0:
        raise ValueError("the central directory is out of range")
    cd, at, out = read(cd_at + shift, cd_size), 0, {}
    for _ in range(count):
        if cd[at:at + 4] != b"PK\x01\x02":
            raise ValueError("bad central directory entry")
        flags, method = struct.unpack_from("<HH", cd, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", cd, at + 20)
        local, = struct.unpack_from("<I", cd, at + 42)
        name = cd[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, k = cd[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            tag, length = struct.unpack_from("<HH", extra, k)
            if tag == 1:
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, k + 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            k += 4 + length
        at += 46 + n_name + n_extra + n_comment
        head = read(local + shift, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"bad local header of {name}")
        out[name] = (local + shift + 30 + sum(struct.unpack_from("<HH", head, 26)), packed, -1 if flags & 1 else method)
    return out


# ---- writing -----------------------------------------------------------------------

class _Archive:
    """An archive being written: records stream into the data member; the index and the package file follow."""

    def __init__(self, store, path: str):
        self.path, self.index, self.bytes, self.sha = path, [], 0, hashlib.sha256()
        self.stream = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)

    def add(self, url: str | None, record: bytes, digest: str, refers_to: int | None, date: str = UNDATED) -> None:
        self.data.write(record)
        self.sha.update(record)
        target = _target(url)
        about = {"url": target, "mime": "text/html" if refers_to is None else "warc/revisit", "status": "200", "digest": f"sha1:{digest}",
                 "length": str(len(record)), "offset": str(self.bytes), "filename": DATA.rsplit("/", 1)[1]}
        self.index.append(f"{sort_key(target)} {re.sub('[^0-9]', '', date)} {json.dumps(about)}\n")
        self.bytes += len(record)

    def full(self) -> bool:
        return self.bytes >= ARCHIVE_BYTES or len(self.index) >= ARCHIVE_RECORDS

    def close(self) -> tuple[str, int]:
        self.data.close()
        index = "".join(sorted(self.index)).encode()
        self.zip.writestr(zipfile.ZipInfo(INDEX), index)
        parts = [(DATA, self.bytes, self.sha), (INDEX, len(index), hashlib.sha256(index))]
        self.zip.writestr(zipfile.ZipInfo(PACKAGE), json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": [
            {"name": p.rsplit("/", 1)[1], "path": p, "hash": f"sha256:{h.hexdigest()}", "bytes": n} for p, n, h in parts]}))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.index)


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages under ``root``; returns the stored manifest (path, records)."""
    body = text_or_empty(F.col(html_col))
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), body.alias("body"),
                     F.sha1(body).alias("digest"), F.octet_length(body).alias("size"))
    shared = stage(p.filter(F.col("size") >= MIN_REVISIT).groupBy("digest")
                   .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
                   .filter("copies > 1 and first_id is not null").select(F.col("digest").alias("same"), "first_id"), "warc-shared")
    rows = p.join(shared, p.digest == shared.same, "left").select(
        "page_id", "url", "body", "digest",
        F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")), F.col("first_id")).alias("refers_to"))

    def run(batches):
        archive, store, folder = None, *open_store(root)
        store.create_dir(folder, recursive=True)
        done = []
        for b in batches:
            for page, url, text, digest, refers in zip(*(c.to_pylist() for c in b.columns)):
                archive = archive or _Archive(store, f"{folder}/{uuid.uuid4().hex}.wacz")
                archive.add(url, make_record(page, url, text.encode("utf-8"), digest, refers), digest, refers)
                if archive.full():
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([root.rstrip("/") + "/" + d[0].rsplit("/", 1)[1] for d in done]),
                                              pa.array([d[1] for d in done], pa.int64())], names=["path", "records"])

    return stage(rows.mapInArrow(run, "path string, records long"), "warc-manifest")


# ---- reading -----------------------------------------------------------------------

def _index_lines(f, at: int, length: int, method: int, name: str):
    """The lines of an index member, streamed: plain or gzip, stored or compressed in the ZIP."""
    if method not in (0, 8):
        raise ValueError(f"{name} cannot be read")
    chunks = _chunks(f, at, length)
    if method == 8:
        z = zlib.decompressobj(-15)
        chunks = (z.decompress(c) for c in chunks)
    if name.endswith(".gz"):
        chunks = _members(chunks)
    held = b""
    for data in chunks:
        *lines, held = (held + data).split(b"\n")
        yield from lines
    yield held


def _entry(line: bytes) -> tuple[str | None, int, int] | None:
    """(data file or None, offset, length) of an index line, whose JSON may follow a key and a time; None for other lines."""
    text = line.decode("utf-8").rstrip("\r")
    if not text.strip() or text[0] in " !":
        return None
    if not text.startswith("{"):
        key_time_json = text.split(" ", 2)
        if len(key_time_json) < 3 or not key_time_json[2].startswith("{"):
            raise ValueError(f"not an index line: {text[:200]}")
        text = key_time_json[2]
    e = json.loads(text)
    return e.get("filename"), int(e["offset"]), int(e["length"])


def _data_member(name: str | None, data: list[str]) -> str:
    """The data member an index means: by its whole name, else by its last part, else the only one."""
    last = (name or "").rsplit("/", 1)[-1]
    fits = [m for m in data if m == name] or [m for m in data if name is None or m.rsplit("/", 1)[-1] == last]
    if len(fits) != 1:
        raise ValueError(f"the index names {name!r}; the data members are {data}")
    return fits[0]


def _ranges(f, size: int):
    """(offset, length, gzip) of blocks of neighbouring records; a member without index entries is one block."""
    def read(offset, length):
        f.seek(offset)
        data = f.read(length)
        if len(data) != length:
            raise ValueError("the archive is cut off")
        return data

    members = zip_directory(read, size)
    found: dict[str, set[tuple[int, int]]] = {m: set() for m in members if m.endswith(DATA_ENDINGS)}
    for m in found:
        if members[m][2] != 0:
            raise ValueError(f"{m} is compressed in the ZIP, so it has no byte ranges")
    named: dict[str | None, str] = {}
    for m in members:
        if m.endswith(INDEX_ENDINGS):
            for line in _index_lines(f, *members[m], m):
                entry = _entry(line)
                if entry:
                    name, offset, length = entry
                    if name not in named:
                        named[name] = _data_member(name, list(found))
                    found[named[name]].add((offset, length))
    for m, entries in found.items():
        data_at, data_size, _ = members[m]
        packed = m.endswith(".gz")
        if not entries:
            if data_size:
                yield data_at, data_size, packed
            continue
        start = end = None
        for offset, length in sorted(entries):
            if offset + length > data_size:
                raise ValueError(f"an index entry lies behind the end of {m}")
            if end is not None and (offset != end or end + length - start > RANGE_BYTES):
                yield data_at + start, end - start, packed
                start = None
            start, end = offset if start is None else start, offset + length
        yield data_at + start, end - start, packed


def read_archives(manifest: DataFrame, payload: bool = False) -> DataFrame:
    """The records of all archives of ``manifest`` (a column ``path``); payloads only when asked for."""
    def locate(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                store, name = open_store(path)
                with store.open_input_file(name) as f:
                    found = list(_ranges(f, f.size()))
                if found:
                    at, length, packed = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(found)), pa.array(at, pa.int64()),
                                                      pa.array(length, pa.int64()), pa.array(packed)], names=["path", "at", "length", "packed"])

    def fetch(batches):
        names = [f.split()[0] for f in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

        def batch(records):
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in records], t) for n, t in zip(names, types)], names=names)

        for b in batches:
            for path, at, length, packed in zip(*(c.to_pylist() for c in b.columns)):
                store, name = open_store(path)
                records, held = [], 0
                with store.open_input_file(name) as f:
                    for raw in records_of(f, at, length, packed):
                        r = parse_record(raw)
                        if r is None:
                            continue
                        held += len(raw) if payload else 200
                        if not payload:
                            r["payload"] = None
                        records.append(r)
                        if held >= RANGE_BYTES:
                            yield batch(records)
                            records, held = [], 0
                if records:
                    yield batch(records)

    n = partitions(manifest.sparkSession)
    ranges = manifest.select("path").repartition(n).mapInArrow(locate, "path string, at long, length long, packed boolean")
    return ranges.repartition(n).mapInArrow(fetch, RECORDS)


def archive_round_trip(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Write the pages' archives, then read every record back: one row per page."""
    root = root or shared_root(pages.sparkSession) + "/warc"
    records = read_archives(write_archives(pages, root))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ROUND_TRIP_SQL = f"""
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
d as (select page_id, octet_length(body) as n, sha1(body) as digest from p),
k as (select digest, max(page_id) as first_id, count(*) as copies from d where n >= {MIN_REVISIT} group by digest)
select d.page_id, d.n::bigint as payload_bytes, d.digest as payload_digest,
  case when k.copies > 1 and d.page_id is distinct from k.first_id then 'revisit' else 'response' end as record_type,
  case when k.copies > 1 and d.page_id is distinct from k.first_id then k.first_id end as refers_to
from d left join k on d.digest = k.digest"""
