"""WARC archives: a deterministic sharded writer with revisits, and a reader.

Records are dealt to shards by ranges of their sort key, sorted inside, and
written as one gzip member each; a shard's file is closed once its compressed
size passes a limit. Headers and digests are made anew from the payload. The
bytes depend on the records and parameters alone: range bounds come from a sample
fixed by a hash, dates and ids from the record, and gzip carries no time.

Every attempt of a task writes under names of its own. Spark keeps one attempt's
list of files a task; those lists are the manifest, from which files take their
final names; others' leftovers go. Renaming may be repeated, so a lost executor
or a second run does no harm. The manifest is written last and is what readers
follow.

Files are opened by pyarrow, so the folder may be on any store that pyarrow
reaches from the executors.

Cases: a null payload is empty; payloads below ``least_revisit`` bytes are always
responses; of equal larger ones that of least id is the response (a null id sorts
last), also among repeated rows, where one of the equal rows is; null URLs are
written as ``urn:none``; line breaks in an URL are escaped; an empty table gives
an empty archive; records longer than a file's limit fill a file alone; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.llm.common import spread_lookup, table
from promoledger.session import new_work_path, stage

#: Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 100
#: A file is closed when its compressed size reaches this.
FILE_BYTES = 16 << 20
#: A shard holds about so many payload bytes.
SHARD_BYTES = 32 << 20
#: Expected rows of the sample that range bounds come from.
SAMPLE = 50_000
# Fixed value: every record's date, so that archives are reproducible.
DATE = "2024-01-01T00:00:00Z"
_CHUNK = 1 << 16
_END = b"\r\n\r\n"

MANIFEST = "shard int, number int, name string, temporary string, records long, bytes long, sha256 string"
READ = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def with_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int = LEAST_REVISIT) -> DataFrame:
    """``id, url, payload, digest, size, origin``: origin is the id of the response that a revisit refers to.

    Digests that occur once need no lookup; the others' least ids are spread over
    salts, since one payload may be a third of all pages.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    large = rows.where(F.col("size") >= least)
    repeated = large.groupBy("digest").agg(F.min("id").alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Written, so that Spark knows its size: while it is small, payloads are not shuffled for it.
    found = spread_lookup(rows, stage(repeated, "repeated-payloads")[0], ["digest"])
    return found.select("id", "url", "payload", "digest", "size", "origin")


def range_bounds(records: DataFrame, sample: int = SAMPLE, shard_bytes: int = SHARD_BYTES) -> list[int]:
    """Ids that divide the records into shards of about equal payload; the same for the same records.

    The sample takes the ids whose hash falls below a share fixed by the row
    count, so it neither depends on partitions nor grows with the table.
    """
    total = records.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    if not total["n"]:
        return []
    shards = max(1, -(-int(total["bytes"] or 0) // shard_bytes))
    share = min(1.0, sample / total["n"])
    below = int(share * (1 << 31))
    drawn = records.where(F.pmod(F.hash("id", F.lit("bounds")), F.lit(1 << 31)) < below).where(F.col("id").isNotNull())
    found = drawn.select("id", "size").toPandas().sort_values(["id", "size"])
    if not len(found):
        return []
    weight = found["size"].to_numpy(np.float64).cumsum() + np.arange(1, len(found) + 1)
    at = np.searchsorted(weight, weight[-1] * np.arange(1, shards) / shards)
    return sorted(set(found["id"].to_numpy()[np.minimum(at, len(found) - 1)].tolist()))


def header(kind: str, fields: list[tuple[str, str]], size: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {size}"]
    return "\r\n".join(lines).encode() + _END


def record_id(page: int | None, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}:{page}:{digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, origin: int | None, revisit: bool) -> bytes:
    """One WARC record as a gzip member; all headers and digests are made here."""
    digest = hashlib.sha256(payload).hexdigest()
    kind = "revisit" if revisit else "response"
    block = b"" if revisit else payload
    fields = [
        ("WARC-Record-ID", record_id(page, digest, kind)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else "urn:none"),
        ("WARC-Page-ID", "" if page is None else str(page)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
    ]
    if url:
        fields.append(("WARC-Source-URI", quote(url, safe="")))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(origin, digest, "response")),
            ("WARC-Refers-To-Page-ID", str(origin)),
        ]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = header(kind, fields, len(block)) + block + _END
    return squeeze.compress(whole) + squeeze.flush()


def _files(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _write_shards(batches: Iterator[pa.RecordBatch], folder: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Write sorted records; yields a manifest row for each closed file. Holds one batch and one file's stream."""
    files, root = _files(folder)
    attempt = uuid.uuid4().hex
    shard, number, out, state = None, 0, None, None
    done: list[tuple] = []

    def close():
        nonlocal out
        if out is not None:
            out.close()
            name = f"part-{shard:05d}-{number:05d}.warc.gz"
            done.append((shard, number, name, state["temporary"], state["records"], state["bytes"], state["hash"].hexdigest()))
            out = None

    for batch in batches:
        for row in range(batch.num_rows):
            at, page, url, payload, origin, revisit = (batch.column(c)[row].as_py() for c in ("shard", "id", "url", "payload", "origin", "revisit"))
            if at != shard or (out is not None and state["bytes"] >= limit):
                close()
                shard, number = at, (number + 1 if at == shard else 0)
            if out is None:
                temporary = f"_temporary/{attempt}-{shard:05d}-{number:05d}"
                out = files.open_output_stream(f"{root}/{temporary}", compression=None)
                state = {"temporary": temporary, "records": 0, "bytes": 0, "hash": hashlib.sha256()}
            data = record(page, url, payload, origin, revisit)
            out.write(data)
            state["records"] += 1
            state["bytes"] += len(data)
            state["hash"].update(data)
    close()
    if done:
        names = ["shard", "number", "name", "temporary", "records", "bytes", "sha256"]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)


def _commit(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    """Give files their final names; a file already there in full was renamed by an earlier attempt."""
    from pyarrow import fs

    files, root = _files(folder)
    for batch in batches:
        for row in batch.itertuples():
            final = files.get_file_info(f"{root}/{row.name}")
            if files.get_file_info(f"{root}/{row.temporary}").type == fs.FileType.File:
                if final.type == fs.FileType.File:
                    files.delete_file(f"{root}/{row.name}")
                files.move(f"{root}/{row.temporary}", f"{root}/{row.name}")
            elif final.type != fs.FileType.File or final.size != row.bytes:
                raise FileNotFoundError(f"{row.temporary} of {row.name} is gone")
        yield batch


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """Write all pages below ``folder``; returns the manifest, as it lies in ``folder/manifest``.

    One shuffle moves payloads, to their shard; each task writes its shards' files
    itself. Within equal ids the digest orders records, and the first of equal
    records is the response.
    """
    spark = pages.sparkSession
    records = with_revisits(pages, id_col, url_col, payload_col, least_revisit)
    keys = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.octet_length(payload_col), F.lit(0)).cast("long").alias("size"))
    bounds = range_bounds(keys, shard_bytes=shard_bytes)
    files, root = _files(folder)
    files.create_dir(f"{root}/_temporary", recursive=True)

    @F.arrow_udf("int")
    def shard_of(ids: pa.Array) -> pa.Array:
        numbers = np.searchsorted(np.array(bounds, np.int64), ids.fill_null((1 << 63) - 1).to_numpy(zero_copy_only=False), side="right")
        return pa.array(numbers.astype(np.int32))

    same = (F.col("origin") == F.col("id")) & F.col("origin").isNotNull()
    dealt = records.withColumn("revisit", F.col("origin").isNotNull() & ~F.coalesce(same, F.lit(False))).withColumn("shard", shard_of("id"))
    # A task a shard: dealt by its number itself, as hashes of few numbers collide. Equal ids and payloads lie side by side in
    # one shard: all but the first of them are revisits too.
    sorted_rows = dealt.repartitionById(max(1, len(bounds) + 1), "shard").sortWithinPartitions("shard", F.col("id").asc_nulls_last(), "digest", "url")
    written = sorted_rows.select("shard", "id", "url", "payload", "digest", "size", "origin", "revisit").mapInArrow(
        partial(_mark_and_write, folder=folder, limit=file_bytes), MANIFEST
    )
    lists = f"{folder}/_lists"
    written.write.mode("overwrite").parquet(lists)
    manifest = spark.read.schema(MANIFEST).parquet(lists)
    named = manifest.repartition("name").mapInPandas(partial(_commit, folder=folder), MANIFEST)
    named.write.mode("overwrite").parquet(f"{folder}/manifest")
    for leftover in ("_temporary", "_lists"):
        files.delete_dir(f"{root}/{leftover}")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _mark_and_write(batches: Iterator[pa.RecordBatch], folder: str, limit: int) -> Iterator[pa.RecordBatch]:
    def marked():
        before = None
        for batch in batches:
            flags = []
            ids, digests = batch.column("id").to_pylist(), batch.column("digest").to_pylist()
            for page, digest, origin, revisit in zip(ids, digests, batch.column("origin").to_pylist(), batch.column("revisit").to_pylist(), strict=True):
                flags.append(revisit or (origin is not None and (page, digest) == before))
                before = (page, digest)
            columns = [batch.column(c) for c in ("shard", "id", "url", "payload", "origin")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(flags, pa.bool_())], ["shard", "id", "url", "payload", "origin", "revisit"])

    return _write_shards(marked(), folder, limit)


class _Members:
    """The uncompressed bytes of a file of gzip members, as a stream."""

    def __init__(self, stream):
        self.stream, self.left, self.buffer, self.squeeze = stream, b"", bytearray(), None

    def _more(self) -> bool:
        data = self.left or self.stream.read(_CHUNK)
        if not data:
            return False
        self.squeeze = self.squeeze or zlib.decompressobj(31)
        self.buffer += self.squeeze.decompress(data)
        self.left = b""
        if self.squeeze.eof:
            self.left, self.squeeze = self.squeeze.unused_data, None
        return True

    def until(self, mark: bytes) -> bytes | None:
        at = self.buffer.find(mark)
        while at < 0:
            start = max(0, len(self.buffer) - len(mark))
            if not self._more():
                return None
            at = self.buffer.find(mark, start)
        found = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return found

    def take(self, size: int) -> bytes:
        while len(self.buffer) < size:
            if not self._more():
                raise EOFError("a record ends early")
        found = bytes(self.buffer[:size])
        del self.buffer[:size]
        return found


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a stream of gzip members; digests are checked."""
    members = _Members(stream)
    while (head := members.until(_END)) is not None:
        first, *lines = head.decode().split("\r\n")
        if not first.startswith("WARC/1."):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        block = members.take(int(fields["Content-Length"]))
        if members.take(len(_END)) != _END:
            raise ValueError("a record's end is missing")
        if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"{fields['WARC-Record-ID']} is damaged")
        yield fields, block


def _read_files(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[pa.RecordBatch]:
    from urllib.parse import unquote

    files, root = _files(folder)
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]
    )
    number = lambda text: int(text) if text else None
    for batch in batches:
        for name in batch.column("name").to_pylist():
            rows, size = [], 0
            with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                for fields, block in parse(stream):
                    source = fields.get("WARC-Source-URI")
                    rows.append(
                        {
                            "page_id": number(fields["WARC-Page-ID"]),
                            "url": unquote(source) if source else None,
                            "record_type": fields["WARC-Type"],
                            "refers_to": number(fields.get("WARC-Refers-To-Page-ID", "")),
                            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
                            "payload_bytes": int(fields["WARC-Payload-Length"]),
                            "payload": None if fields["WARC-Type"] == "revisit" else block,
                        }
                    )
                    size += len(block)
                    if size > 4 << 20 or len(rows) >= 5_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all files that the manifest of ``folder`` names, one task a file; a revisit's payload is null."""
    names = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("name", "bytes")
    count = max(1, names.count())
    # One short row a file; dealt out in turn from one place, so that no task gets two.
    return names.coalesce(1).repartition(count).mapInArrow(partial(_read_files, folder=folder), READ)


def query(spark, sf_dir: str) -> DataFrame:
    """op3: all pages written as WARC and read back."""
    folder = new_work_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return read_archive(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
with payloads as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
firsts as (select *, min(page_id) over (partition by payload_digest) as first from payloads)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
       case when payload_bytes >= {LEAST_REVISIT} and page_id <> first then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= {LEAST_REVISIT} and page_id <> first then first end as refers_to
from firsts
"""
