"""WARC archives of pages, and an index of them merged from sorted runs."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.llm.common import per_batch, table, written
from kindling.session import scratch_path

#: Payloads of fewer bytes are stored each; records a file; index rows that one task merges.
MIN_SHARED, FILE_RECORDS, MERGE_ROWS = 1000, 2000, 50_000
#: Bytes that a file's records may have together.
FILE_BYTES = 1 << 28
EPOCH = 1_704_067_200  # the time of page 0, if pages have none: 2024-01-01
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def _one_line(col: Column) -> Column:
    """A header value: no line ends, which are percent-encoded."""
    return F.replace(F.replace(col, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def with_revisits(spark: SparkSession, pages: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``digest`` and ``refers_to``: of pages
    with equal payloads of at least ``min_shared`` bytes the page whose payload
    this one repeats (the greatest ``page_id``), null if it has its own. A null
    ``page_id`` is less than any other; rows that repeat a page's id and payload are what that page is. Other columns are not read.

    Only digests are grouped; the pages that repeat one are a table of their
    own, to which pages are joined by page, so no payload that many pages
    share meets its copies in one task."""
    html = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select("page_id", "url", html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("digest"))
    large = pages.where(F.octet_length("html") >= min_shared).select("page_id", "digest")
    large = written(spark, large, "page-digests")
    # A page without an id repeats the greatest id's, too; without any id there is nothing to refer to.
    shared = large.groupBy("digest").agg(F.max("page_id").alias("last"), F.min("page_id").alias("first"), F.count("page_id").alias("named"), F.count("*").alias("n"))
    shared = shared.where((F.col("first") < F.col("last")) | (F.col("named") > 0) & (F.col("named") < F.col("n")))
    shared = written(spark, shared.select(F.col("digest").alias("same"), "last"), "shared-payloads")
    repeats = large.join(shared, F.col("digest") == F.col("same")).where(~F.col("page_id").eqNullSafe(F.col("last")))
    repeats = written(spark, repeats.select(F.col("page_id").alias("id"), F.col("digest").alias("of"), F.col("last").alias("refers_to")).distinct(), "revisits")
    joined = pages.join(repeats, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left")
    return joined.select("page_id", "url", "html", "digest", "refers_to")


def records(pages: DataFrame) -> DataFrame:
    """``record``: each page as one WARC/1.1 record, without the two line ends that follow it.

    A response holds an HTTP header and the payload, a revisit the header
    alone and which record it refers to; the payload's digest is in both."""
    revisit = F.col("refers_to").isNotNull()
    block = F.concat(F.lit(_HTTP), F.when(revisit, "").otherwise(F.col("html")))
    seconds = F.lit(EPOCH) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(10**9))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.coalesce(_record_id(F.col("page_id")), F.lit("<urn:page:>"))),
        line("WARC-Date", F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", _one_line(F.col("url")))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.upper(F.to_char(F.unhex("digest"), F.lit("hex"))))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_PROFILE)), line("WARC-Refers-To", _record_id(F.col("refers_to"))))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return pages.select(F.concat(head, F.lit("\r\n"), block).alias("record"))


def write_archives(spark: SparkSession, pages: DataFrame, path: str, min_shared: int = MIN_SHARED, file_records: int = FILE_RECORDS) -> None:
    """Writes every page as a record of WARC files below ``path``.

    Records are text, so Spark's own writer makes the files wherever Spark can
    write: its line separator is the two line ends between records. A file
    holds ``file_records`` records at most, and fewer where pages are so long that these could pass ``FILE_BYTES``: a file is read
    as one value. No pages make no record."""
    longest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    file_records = max(1, min(file_records, FILE_BYTES // (longest + 10_000)))
    out = records(with_revisits(spark, pages, min_shared))
    out.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", file_records).text(path)


def parse(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header, block) of each record of an archive file."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at) + 4
        header = {k.decode().lower(): v.decode("utf-8", "replace") for k, v in _HEADER.findall(content, at, end)}
        stop = end + int(header["content-length"])
        yield at, stop + 4 - at, header, content[end:stop]
        at = stop + 4


def url_key(url: str | None) -> str:
    """The key that sorts captures of one host and its subdomains together: host labels reversed, then the path."""
    if not url:
        return ""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url).split("#", 1)[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host = rest[:cut].rpartition("@")[2].lower().partition(":")[0]
    host = host.removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (rest[cut:] or "/")


_INDEX = ("url_key string, time string, page_id long, file string, offset long, length long, payload_digest string, "
          "record_type string, refers_to long, payload_bytes long")


def _page(uri: str | None) -> int | None:
    return int(uri[len("<urn:page:"):-1] or 0) if uri and uri != "<urn:page:>" else None


@per_batch
def _index(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        for offset, length, h, block in parse(content.as_py()):
            body = block[block.index(b"\r\n\r\n") + 4:]
            kind, digest = h["warc-type"], h["warc-payload-digest"].removeprefix("sha1:").lower()
            if kind == "response" and hashlib.sha1(body).hexdigest() != digest:
                raise ValueError(f"{file}: the payload at {offset} does not have its digest")
            rows.append((url_key(h.get("warc-target-uri")), h["warc-date"], _page(h["warc-record-id"]), file, offset, length,
                         digest, kind, _page(h.get("warc-refers-to")), len(body) if kind == "response" else None))
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [x.split()[0] for x in _INDEX.split(", ")])


class LoserTree:
    """k-way merge: leaves are the heads of sorted runs, each inner node keeps
    the loser of its match, so the next head replays one path to the root."""

    def __init__(self, runs: list[list]):
        self.runs, self.heads, self.k = runs, [0] * len(runs), max(1, len(runs))
        self.losers = [-1] * self.k
        for leaf in range(len(runs)):
            self._play(leaf)

    def _before(self, a: int, b: int) -> bool:
        over_a, over_b = self.heads[a] >= len(self.runs[a]), self.heads[b] >= len(self.runs[b])
        if over_a or over_b:
            return not over_a
        x, y = self.runs[a][self.heads[a]], self.runs[b][self.heads[b]]
        return x < y or (x == y and a < b)

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # the first to come here waits for the other side
                self.losers[node] = winner
                return
            if self._before(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.runs:
            run = self.losers[0]
            if self.heads[run] >= len(self.runs[run]):
                return
            yield self.runs[run][self.heads[run]]
            self.heads[run] += 1
            self._play(run)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the index out of the parts that the sorted runs have of it."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held).combine_chunks()
    run, key, time, page, file, offset = (whole.column(i).to_pylist() for i in range(6))
    keys = list(zip(key, time, [(p is None, p or 0) for p in page], file, offset, strict=True))
    runs: dict[int, list] = {}
    for i, r in enumerate(run):
        part = runs.setdefault(r, [])
        if part and keys[i] < part[-1][0]:
            raise ValueError("a run is not sorted")
        part.append((keys[i], i))
    order = [i for _, i in LoserTree([runs[r] for r in sorted(runs)])]
    yield from whole.take(pa.array(order, pa.int64())).drop_columns(["run"]).to_batches(max_chunksize=10_000)


def capture_index(spark: SparkSession, path: str, merge_rows: int = MERGE_ROWS) -> DataFrame:
    """The index of the archives below ``path``: a row per record, in the order
    of URL key, time, page, file and offset over all partitions, so that the
    captures of a URL are one history.

    Files are parsed by Content-Length and checked against their digests; each
    task sorts what it parsed and writes it as a run. A task of the merge gets
    one range of the key (about ``merge_rows`` rows; a URL captured very often
    is cut by time) from every run, still in order, and merges them with a
    loser tree. ``payload_bytes`` is null for revisits. No archives give no rows."""
    parsed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content").mapInArrow(_index, _INDEX)
    order = ["url_key", "time", F.col("page_id").asc_nulls_last(), "file", "offset"]
    runs = written(spark, parsed.withColumn("run", F.spark_partition_id()).sortWithinPartitions(*order), "index-runs")
    parts = max(1, -(-runs.count() // merge_rows))
    # Within a run of one range the sort keeps the order it has; it only brings runs together as they left their tasks.
    ranges = runs.repartitionByRange(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))), *order).sortWithinPartitions("run", *order)
    return ranges.select("run", *(x.split()[0] for x in _INDEX.split(", "))).mapInArrow(_merge, _INDEX)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(spark, table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    index = written(spark, capture_index(spark, path), "capture-index")
    # A revisit has the payload of the response that it refers to.
    targets = index.where("record_type = 'response'").select(F.col("page_id").alias("id"), F.col("payload_digest").alias("of"), F.col("payload_bytes").alias("bytes")).distinct()
    revisits = index.where("record_type = 'revisit'").join(targets, (F.col("refers_to") == F.col("id")) & (F.col("payload_digest") == F.col("of")))
    revisits = revisits.withColumn("payload_bytes", F.col("bytes"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return index.where("record_type = 'response'").select(columns).unionByName(revisits.select(columns))


OP8_SQL = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), last AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_page FROM sized
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND last_page IS NOT NULL AND page_id IS DISTINCT FROM last_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last_page THEN last_page END AS refers_to
FROM last
"""
