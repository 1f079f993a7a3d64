"""WARC archives: writing records, and reading them back by verified boundaries.

Writing: payloads get their SHA-1, and of records with equal payloads the one
with the largest page id keeps it; the others become revisits that refer to it.
Each task writes its records to its own files through Spark's text writer,
whose line separator is the blank line that ends a record.

Reading: files are split at byte ranges, and every place that looks like a
record's start is a candidate, whether it is one or only stands in a payload.
A task parses its candidates and emits for each the offset where the next
record must begin. Records are the candidates that can be reached from a file's
first byte: jump pointers are doubled until all chains end, so no task walks a
file. Payloads that hold such places come in pieces; those records' pieces are
read again and put together.

Defined cases: a null or empty payload is an empty one; a null url is left out;
a null page id is written without an id, and takes the largest id's place only
if a payload has no other; rows that repeat are a record each, of which those
with the largest id are responses; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.session import stage, staging_path

# What a reader looks for. Spark takes it out as a line separator, so a chunk
# starts with the version's last digit.
MAGIC = b"\r\nWARC/1."
END = "\r\n\r\n"
RECORDS_PER_FILE = 100_000
# Slots of a bitmap that tells tasks which pieces to read again.
SLOTS = 1 << 20
STRETCH = 1 << 20

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads compressed, with digest and size: only these move to where equal ones meet."""
    for batch in batches:
        payloads = [x or b"" for x in batch.column("_payload").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_url"), pa.array([zlib.compress(p, 6) for p in payloads], pa.binary()),
             pa.array(map(len, payloads), pa.int64()), pa.array(map(payload_digest, payloads), pa.string())],
            ["_id", "_url", "_packed", "_size", "_digest"],
        )


def _record(page: int | None, url: str | None, packed: bytes, size: int, digest: str, response: int | None) -> bytes:
    revisit = response is not None and response != page
    http = _HTTP.format(size).encode()
    block = http if revisit else http + zlib.decompress(packed)
    name = "none" if page is None else page
    head = [
        "WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(2, f"WARC-Target-URI: {' '.join(url.split())}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{response}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("_id", "_url", "_packed", "_size", "_digest", "_response")]
        for start in range(0, batch.num_rows, 256):
            rows = zip(*(c[start : start + 256] for c in columns))
            records = pa.array([_record(*row) for row in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([records], ["record"])


def write(
    pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html", least: int = 0
) -> None:
    """One record a row; equal payloads of at least `least` bytes are written once."""
    narrow = pages.select(
        F.col(id_col).cast("bigint").alias("_id"), F.col(url).alias("_url"), F.col(payload).cast("binary").alias("_payload")
    )
    digested = narrow.mapInArrow(_digest, "_id bigint, _url string, _packed binary, _size bigint, _digest string")
    # Written on its own, so that the join below is of two plain shuffles and a hot payload's side can be split.
    ids = narrow.select("_id", "_payload").withColumn("_url", F.lit(None).cast("string")).mapInArrow(
        _ids, "_digest string, _size bigint, _id bigint"
    )
    responses = stage(
        ids.filter(F.col("_size") >= least).groupBy("_digest").agg(F.max("_id").alias("_response"), F.count("*").alias("_n"))
        .filter("_n > 1"),
        "warc-responses",
    )
    shared = responses.drop("_n")
    joined = digested.join(shared, "_digest", "left").select("_id", "_url", "_packed", "_size", "_digest", "_response")
    records = joined.mapInArrow(_records, "record binary").select(F.col("record").cast("string"))
    records.write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [x or b"" for x in batch.column("_payload").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(map(payload_digest, payloads), pa.string()), pa.array(map(len, payloads), pa.int64()),
             batch.column("_id")], ["_digest", "_size", "_id"],
        )


def _field(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        if line[: len(name) + 1].lower() == name.lower() + b":":
            return line[len(name) + 1 :].strip().decode("utf-8", "replace")
    return None


def _page(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _parse(chunk: bytes, first: bool) -> tuple[int, bytes, bytes, int] | None:
    """Bytes to the next record, header, the block as far as the chunk has it, and its full size."""
    lead = b"WARC/1." if first else b""
    end = chunk.find(b"\r\n\r\n")
    if end < 0 or not chunk.startswith(lead):
        return None
    head = chunk[:end]
    length = _field(head, b"Content-Length")
    if length is None or not length.isdigit() or _field(head, b"WARC-Type") is None:
        return None
    # Counted from the magic's first letter, which a later chunk has lost.
    size = int(length)
    return end + 4 + size + len(END) + (0 if first else len(MAGIC) - 2), head, chunk[end + 4 :], size


def _body(block: bytes) -> tuple[bytes, int]:
    """Payload and the size its HTTP header states."""
    end = block.find(b"\r\n\r\n")
    stated = _field(b"\r\n" + block[: max(end, 0)], b"Content-Length")
    return (block[end + 4 :] if end >= 0 else block), int(stated) if stated and stated.isdigit() else 0


_CANDIDATE = (
    "_file string, _block bigint, _at bigint, _span bigint, _next bigint, page_id bigint, record_type string, "
    "refers_to bigint, stated_digest string, payload_bytes bigint, payload_digest string, _whole boolean, _chunk binary"
)


def _candidates(batches: Iterator[pa.RecordBatch], bits: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Every chunk of this task's byte ranges, with its place in the range and what its header says.

    `bits`: chunks whose place falls into a set slot keep their bytes.
    """
    schema = pa.schema([
        ("_file", pa.string()), ("_block", pa.int64()), ("_at", pa.int64()), ("_span", pa.int64()), ("_next", pa.int64()),
        ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("stated_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("_whole", pa.bool_()), ("_chunk", pa.binary()),
    ])
    place, at = None, 0
    for batch in batches:
        rows = []
        files, blocks = batch.column("_file").to_pylist(), batch.column("_block").to_pylist()
        for file, block, value in zip(files, blocks, batch.column("_value")):
            chunk = value.as_py()
            if (file, block) != place:
                place, at = (file, block), 0
            first = at == 0 and block == 0
            span = len(chunk) + len(MAGIC)
            row = dict.fromkeys(schema.names) | {"_file": file, "_block": block, "_at": at, "_span": span, "_whole": False}
            if parsed := _parse(chunk, first):
                jump, head, content, size = parsed
                # A record's end and the next one's magic share a line break.
                whole = len(content) >= size and len(content) <= size + len(END)
                row |= {
                    "_next": jump, "page_id": _page(_field(head, b"WARC-Record-ID")), "record_type": _field(head, b"WARC-Type"),
                    "refers_to": _page(_field(head, b"WARC-Refers-To")),
                    "stated_digest": (_field(head, b"WARC-Payload-Digest") or "").removeprefix("sha1:"), "_whole": whole,
                }
                if whole:
                    payload, stated = _body(content[:size])
                    revisit = row["record_type"] == "revisit"
                    row["payload_bytes"] = stated if revisit else len(payload)
                    row["payload_digest"] = row["stated_digest"] if revisit else payload_digest(payload)
            if bits is not None and bits[_slot(file, block, at)]:
                row["_chunk"] = chunk
            rows.append(row)
            at += span
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _slot(file: str, block: int, at: int) -> int:
    return zlib.crc32(f"{file}:{block}:{at}".encode()) % SLOTS


def _slots() -> F.Column:
    """The same slot, as a column."""
    place = F.concat_ws(":", "_file", F.col("_block").cast("string"), F.col("_at").cast("string"))
    return F.pmod(F.crc32(place), F.lit(SLOTS))


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("value").cast("binary").alias("_value"),
    )


def reachable(links: DataFrame) -> DataFrame:
    """`_file, at` of the links `_file, at, next` that chains from offset 0 reach, by pointer jumping.

    In each round a reached offset reaches its pointer's target, and each pointer
    jumps as far again, so rounds follow the logarithm of a file's records.
    """
    jumps = stage(links.filter("next > at").select("_file", "at", F.col("next").alias("to")), "warc-jumps")
    nodes = jumps.select("_file", "at")
    found = stage(nodes.filter("at = 0"), "warc-found")
    while True:
        step = found.join(jumps, ["_file", "at"]).select("_file", F.col("to").alias("at"))
        onward = stage(found.union(step.join(nodes, ["_file", "at"], "left_semi")).distinct(), "warc-found")
        ahead = jumps.select("_file", F.col("at").alias("to"), F.col("to").alias("far"))
        longer = jumps.join(ahead, ["_file", "to"]).select("_file", "at", F.col("far").alias("to"))
        jumps = stage(longer, "warc-jumps")
        found = onward
        if jumps.isEmpty():
            return found


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row a record: page_id, payload_bytes, payload_digest, record_type, refers_to and `intact`.

    `intact`: the payload read has the digest that the record states.
    """
    chunks = _chunks(spark, path)
    found = stage(chunks.mapInArrow(_candidates, _CANDIDATE).drop("_chunk"), "warc-candidates")
    # Offsets in the file: a range's chunks follow those of all ranges before it. One row a range here.
    ranges = found.groupBy("_file", "_block").agg(F.sum("_span").alias("bytes"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = ranges.select("_file", "_block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"))
    # The first chunk has not lost its magic, so all places after it are seven bytes early.
    lead = len(MAGIC) - 2
    offset = F.col("base") + F.col("_at")
    placed = found.join(base, ["_file", "_block"]).withColumn(
        "at", F.when(offset == 0, offset).otherwise(offset - lead)
    )
    placed = stage(placed.withColumn("next", F.col("at") + F.col("_next")).drop("base"), "warc-placed")
    reached = reachable(placed.filter("_next is not null").select("_file", "at", "next"))
    records = stage(placed.join(reached, ["_file", "at"], "left_semi"), "warc-records")
    fields = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "stated_digest"]
    broken = records.filter("not _whole").select("_file", "at", "next", *fields)
    # Chunks meet the broken record they lie in by stretches of the file.
    spans = broken.select(
        "_file", F.col("at").alias("start"), F.col("next").alias("stop"),
        F.explode(F.sequence(F.expr(f"at div {STRETCH}"), F.expr(f"next div {STRETCH}"))).alias("stretch"),
    )
    pieces = placed.withColumn("stretch", F.expr(f"at div {STRETCH}")).join(spans, ["_file", "stretch"])
    pieces = stage(pieces.filter("at >= start and at < stop").select("_file", "_block", "_at", "at", "start"), "warc-pieces")
    slots = pieces.select(_slots().alias("slot")).distinct().toArrow().column(0).to_numpy()
    whole = records.filter("_whole").select(*fields)
    if len(slots):
        bits = np.zeros(SLOTS, bool)
        bits[slots] = True
        again = chunks.mapInArrow(partial(_candidates, bits=bits), _CANDIDATE).filter("_chunk is not null")
        gathered = again.select("_file", "_block", "_at", "_chunk").join(pieces, ["_file", "_block", "_at"])
        bodies = gathered.groupBy("_file", F.col("start").alias("at")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("at").alias("place"), "_chunk"))).alias("parts")
        )
        joined = broken.join(bodies, ["_file", "at"]).select(*fields, "at", "parts")
        whole = whole.union(
            joined.mapInArrow(
                _join_parts,
                "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
                "stated_digest string",
            )
        )
    intact = F.col("payload_digest") == F.col("stated_digest")
    return whole.select(*fields[:5], intact.alias("intact"))


def _join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put a record's pieces together again and read its payload."""
    for batch in batches:
        rows = batch.to_pylist()
        out = []
        for row in rows:
            raw = MAGIC.join(part["_chunk"] for part in row.pop("parts"))
            _, _, content, size = _parse(raw, row.pop("at") == 0)
            payload, stated = _body(content[:size])
            revisit = row["record_type"] == "revisit"
            row["payload_bytes"] = stated if revisit else len(payload)
            row["payload_digest"] = row["stated_digest"] if revisit else payload_digest(payload)
            out.append(row)
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
            ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("stated_digest", pa.string()),
        ]))


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write all pages to a new folder below the shared one, and read them back."""
    path = staging_path(pages.sparkSession, "warc")
    write(pages, path, **options)
    return read(pages.sparkSession, path)
