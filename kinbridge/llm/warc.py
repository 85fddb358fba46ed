"""WARC archives: writing, and reading back by verified chains of record boundaries.

Writing is one text write whose line separator is the blank lines between records.  Pages
with equal payloads of at least ``REVISIT_BYTES`` bytes have one response record, that of
the smallest page id; the others are revisit records, which refer to it and hold no
payload.

Reading splits the files at the record magic, so a payload that holds the magic yields
false candidates.  Every task numbers the candidates of its part of a file, works out
from their headers where each record would end, and follows these successors as far as
its part goes.  Pointer jumping over the parts, doubling the stride each round, then finds
which parts' entries are reached from the start of the file.  Only candidates on that
chain are records.  A record whose payload was cut apart is put together again, and one
that ends behind its file is left out.  Offsets are added up from the lengths of the
pieces, so parts are read independently.

Null pages have an empty payload, null urls no target field, and rows with a null page id
no page field; null ids never hold the response of others.  Rows with equal id and payload
are written alike.  Line ends in urls are escaped.  An empty table writes an empty archive.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinbridge.llm.common import small_side, staged

MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_M, _G = MAGIC.encode(), GAP.encode()


def _field(name: str, value) -> F.Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def _record_id(page_id, digest) -> F.Column:
    h = F.md5(F.concat_ws("/", page_id.cast("string"), digest).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archive(pages: DataFrame, path: str) -> None:
    """Writes one record per row of (page_id, url, html)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(
            F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A"
        ).alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"),
    ).withColumns(
        {
            "bytes": F.octet_length("payload"),
            "digest": F.sha2(F.col("payload").cast("binary"), 256),
        }
    )
    # Digests are added up before they are dealt out, and only shared ones are joined; as
    # long as these are few, payloads are not dealt out at all.
    shared = staged(
        pages.sparkSession,
        rows.where(F.col("bytes") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("digest", "first"),
        "warc-shared",
    )
    joined = rows.join(small_side(shared), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(GAP),
    )
    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, "payload"))
    header = F.concat(
        F.lit(MAGIC),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _field("Page-ID", F.col("page_id")),
        _field("WARC-Profile", F.when(revisit, PROFILE)),
        _field("WARC-Refers-To", F.when(revisit, _record_id(F.col("first"), F.col("digest")))),
        _field("Refers-To-Page-ID", F.when(revisit, F.col("first"))),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        F.lit("Content-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(GAP),
    )
    joined.withColumn("block", block).select(F.concat(header, "block").alias("value")).write.option(
        "lineSep", GAP
    ).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between two magics, with the part of the file it was read from."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("part"),
            F.col("value").cast("binary").alias("value"),
        )
    )


def _parse(piece: bytes) -> dict | None:
    """Header fields of a record without its magic, and the places of its parts."""
    head = piece.find(_G)
    if head < 0:
        return None
    fields = {}
    for line in piece[:head].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or b"warc-type" not in fields:
        return None
    start = head + len(_G)
    return {"fields": fields, "start": start, "end": start + int(length)}


def _described(record: dict, piece: bytes) -> tuple:
    """(kind, page_id, refers_to, digest in the header, payload size, payload digest)."""
    fields = record["fields"]
    number = lambda x: int(x) if x is not None else None
    block = piece[record["start"] : record["end"]]
    payload = block.partition(_G)[2]
    return (
        fields[b"warc-type"].decode(),
        number(fields.get(b"page-id")),
        number(fields.get(b"refers-to-page-id")),
        fields.get(b"warc-payload-digest", b"").decode().removeprefix("sha256:"),
        len(payload),
        hashlib.sha256(payload).hexdigest(),
    )


_ABOUT = (
    "kind string, page_id long, refers_to long, stated string, "
    "payload_bytes long, payload_digest string"
)
_CANDIDATE = (
    f"file string, part long, seq long, at long, size long, leave long, whole boolean, {_ABOUT}"
)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int, int, bytes]]:
    """((file, part), number in the part, offset in the part, piece) in order of the file."""
    now, seq, at = None, 0, 0
    for batch in batches:
        for file, part, value in zip(*(batch.column(c) for c in range(3)), strict=True):
            here = (file.as_py(), part.as_py())
            if here != now:
                now, seq, at = here, 0, 0
            piece = value.as_py()
            yield here, seq, at, piece
            seq += 1
            at += len(piece) + len(_M)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of a task, each with where its chain leaves the part.

    Offsets count from the first piece of the part; the magic stands before a piece.  The
    row with seq -1 tells the length of the part.
    """
    fields = [f.split() for f in _CANDIDATE.split(", ")]
    names = [name for name, _ in fields]
    kinds = [{"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[k] for _, k in fields]

    def part_rows(here: tuple, rows: list, end: int) -> pa.RecordBatch:
        leave: dict[int, int | None] = {}
        for row in reversed(rows):
            goal = None if row["size"] is None else row["at"] + row["size"]
            if goal is not None and goal < end - len(_M):
                goal = leave.get(goal)
            leave[row["at"]] = goal
        out = [
            (*here, r["seq"], r["at"], r["size"], leave[r["at"]], r["whole"], *r["about"])
            for r in rows
        ]
        out.append((*here, -1, end, None, None, False, *[None] * 6))
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
        )

    now, rows, end = None, [], 0
    for here, seq, at, piece in _runs(batches):
        if here != now:
            if now is not None:
                yield part_rows(now, rows, end)
            now, rows = here, []
        record = _parse(piece)
        size = None if record is None else len(_M) + record["end"] + len(_G)
        whole = size is not None and size <= len(_M) + len(piece)
        rows.append(
            {
                "seq": seq,
                "at": at - len(_M),
                "size": size,
                "whole": whole,
                "about": _described(record, piece) if whole else (None,) * 6,
            }
        )
        end = at + len(piece) + len(_M)
    if now is not None:
        yield part_rows(now, rows, end)


def _reached(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """(file, off) of every part's entry on the chain from the start of its file."""
    jump = staged(
        spark,
        nodes.where(F.col("leave").isNotNull()).select("file", "off", F.col("leave").alias("to")),
        "warc-jumps",
    )
    seen = nodes.where("off = 0").select("file", "off")
    n = -1
    while True:
        # Everything within 2^k parts is known; a jump spans 2^k parts.
        ahead = seen.join(jump, ["file", "off"]).select("file", F.col("to").alias("off"))
        seen = staged(spark, seen.union(ahead).distinct(), "warc-reached")
        before, n = n, seen.count()
        if n == before:
            return seen
        again = jump.select("file", F.col("off").alias("to"), F.col("to").alias("far"))
        jump = staged(
            spark,
            jump.join(again, ["file", "to"]).select("file", "off", F.col("far").alias("to")),
            "warc-jumps",
        )


def _walk(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one part, the candidates on the chain from its entry."""
    size = dict(zip(rows["off"].tolist(), rows["size"].tolist(), strict=True))
    at, found = int(rows["entry"].iloc[0]), []
    while at in size:
        found.append(at)
        if pd.isna(size[at]):
            break
        at += int(size[at])
    return pd.DataFrame({"file": rows["file"].iloc[0], "off": found})


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "part", "seq", "value"]
    for (file, part), seq, _, piece in _runs(batches):
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (file, part, seq, piece)], names)


def _joined(spark: SparkSession, path: str, nodes: DataFrame, records: DataFrame) -> DataFrame:
    """Records that the magic in their payload had cut apart."""
    cut = records.where("NOT whole").select("file", F.col("off").alias("owner"))
    own = records.select("file", "off", F.col("off").alias("start"))
    # Narrow rows of one file; its size bounds them.
    in_file = Window.partitionBy("file").orderBy("off")
    members = (
        nodes.select("file", "part", "seq", "off")
        .join(own, ["file", "off"], "left")
        .withColumn("owner", F.last("start", ignorenulls=True).over(in_file))
        .join(cut, ["file", "owner"], "left_semi")
        .select("file", "part", "seq", "off", "owner")
    )
    pieces = _pieces(spark, path).mapInArrow(
        _numbered, "file string, part long, seq long, value binary"
    )
    whole = (
        pieces.join(members, ["file", "part", "seq"])
        .groupBy("file", "owner")
        .agg(F.sort_array(F.collect_list(F.struct("off", "value"))).alias("parts"))
        .select("parts.value")
    )

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in _ABOUT.split(", ")]
        for batch in batches:
            out = []
            for values in batch["value"]:
                piece = _M.join(values)
                record = _parse(piece)
                if record is not None and record["end"] <= len(piece):
                    out.append(_described(record, piece))
            frame = pd.DataFrame(out, columns=names)
            for c in ("page_id", "refers_to", "payload_bytes"):
                frame[c] = frame[c].astype("Int64")
            yield frame

    return whole.mapInPandas(describe, _ABOUT)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record."""
    pieces = _pieces(spark, path)
    found = staged(spark, pieces.mapInArrow(_candidates, _CANDIDATE), "warc-pieces")
    in_file = Window.partitionBy("file").orderBy("part")
    bases = (
        found.where("seq = -1")
        .withColumn(
            "base",
            F.coalesce(
                F.sum("at").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .select("file", "part", "base")
    )
    placed = (
        found.where("seq >= 0")
        .join(bases, ["file", "part"])
        .withColumn("off", F.col("base") + F.col("at"))
        .withColumn("leave", F.col("base") + F.col("leave"))
    )
    nodes = staged(spark, placed.where("off >= 0"), "warc-candidates")
    entries = _reached(spark, nodes)
    by_part = nodes.join(entries, ["file", "off"], "left_semi").groupBy("file", "part").agg(
        F.min("off").alias("entry")
    )
    # The chain enters a part once, so its entries are one.
    narrow = nodes.select("file", "part", "off", "size").join(by_part, ["file", "part"])
    chain = narrow.groupBy("file", "part").applyInPandas(_walk, "file string, off long")
    records = staged(spark, nodes.join(chain, ["file", "off"], "left_semi"), "warc-records")
    about = [f.split()[0] for f in _ABOUT.split(", ")]
    whole = records.where("whole").select(*about)
    if records.where("NOT whole").limit(1).count():
        whole = whole.union(_joined(spark, path, nodes, records).select(*about))
    response = whole.where("kind = 'response'")
    targets = (
        response.where(F.col("page_id").isNotNull())
        .groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated"))
        .agg(F.min("payload_bytes").alias("target_bytes"))
    )
    revisits = (
        whole.where("kind = 'revisit'")
        .join(targets, ["refers_to", "stated"], "left")
        .select(
            "page_id",
            F.col("target_bytes").alias("payload_bytes"),
            F.col("stated").alias("payload_digest"),
            F.col("kind").alias("record_type"),
            "refers_to",
        )
    )
    return response.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("kind").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
    ).union(revisits)
