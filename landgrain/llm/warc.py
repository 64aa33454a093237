"""WARC archives and their capture index.

Every page becomes one WARC record; equal payloads of some size are stored once and
revisited.  The archives are read back record by record.  Each file gives a run of
index entries sorted by URL key and time; runs are cut into ranges of the global
order and every range is merged from its runs by a loser tree.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgrain.llm.book import query, table
from landgrain.llm.spaces import cut, new_path

END = "\r\n\r\n"
EPOCH = 1704067200
"""2024-01-01, the capture time of a page without one."""

ENTRY = "run string, ord long, url_key string, ts string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
MERGED = "range_no long, seq long, capture_no long, url_key string, ts string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def with_owners(pages: DataFrame, smallest: int = 100) -> DataFrame:
    """Add payload, size, digest and `owner`: the smallest page_id with the same payload, if it is long enough."""
    sized = pages.withColumn("payload", F.coalesce("html", F.lit(""))).withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    owners = sized.where(F.col("payload_bytes") >= smallest).groupBy("payload_digest").agg(F.min("page_id").alias("owner"))
    return sized.join(owners, "payload_digest", "left")


def write_archives(pages: DataFrame, path: str, smallest: int = 100) -> None:
    """Write one WARC/1.1 record per page into gzip files under `path`.

    Columns: page_id, url, html, and `captured` (a timestamp).  Null html is an empty
    payload, a null url an empty target, and a null page_id has no number in its record
    id.  A revisit record has no payload; its headers keep size and digest.  Pages with
    the owner's page_id are responses.  Line breaks in a url are percent-encoded.
    """
    revisit = F.col("owner").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("owner"), F.lit(False))
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    stored = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", urn(F.col("owner"))))).otherwise(F.lit("")),
        line("Content-Length", F.octet_length(stored).cast("string")),
        F.lit("\r\n"),
        stored,
    )
    with_owners(pages, smallest).select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of every record, found by its Content-Length."""
    at, end = 0, END.encode()
    while at < len(archive):
        stop = archive.index(end, at)
        lines = archive[at:stop].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        start = stop + len(end)
        yield headers, archive[start : start + size]
        at = start + size + len(end)


def url_key(url: str) -> str:
    """Host labels reversed, then path and query, without scheme, `www.`, default port and fragment; lower case."""
    try:
        u = urlsplit(url.strip())
        host, port = u.hostname or "", u.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    labels = host.removeprefix("www.").split(".")
    tail = f":{port}" if port and port not in (80, 443) else ""
    ask = "?" + "&".join(sorted(u.query.split("&"))) if u.query else ""
    return (",".join(reversed(labels)) + tail + ")" + (u.path or "/") + ask).lower()


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _order(entry: tuple) -> tuple:
    """URL key, time, page (null first), then the rest to settle ties."""
    key, ts, page, *rest = entry
    return key, ts, page is not None, page or 0, [(x is not None, x) for x in rest if x is not None]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives under `path`; the entries of a file are one sorted run.

    Size and digest of a response come from the payload that was read; a digest that
    differs from the header's is an error.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                found = []
                for headers, payload in records(gzip.decompress(content)):
                    kind, size = headers["WARC-Type"], int(headers["Payload-Length"])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind == "response":
                        size = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{name}: payload of {headers['WARC-Record-ID']} was changed")
                    url = headers["WARC-Target-URI"]
                    found.append((url_key(url), headers["WARC-Date"], _page(headers["WARC-Record-ID"]), url, size, digest, kind, _page(headers.get("WARC-Refers-To"))))
                found.sort(key=_order)
                out = pd.DataFrame(found, columns=["url_key", "ts", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                for c in ("page_id", "refers_to", "payload_bytes"):
                    out[c] = out[c].astype("Int64")
                out.insert(0, "ord", range(len(out)))
                out.insert(0, "run", name)
                yield out

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInPandas(read, ENTRY)


class LoserTree:
    """Merge sorted runs: inner nodes keep the loser of each match, so one path is replayed per item."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.k = len(runs)
        self.losers = [-1] * max(1, self.k)
        for run in range(self.k):
            self._replay(run)

    def _head(self, run: int):
        return self.runs[run][self.at[run]][0] if self.at[run] < len(self.runs[run]) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _replay(self, run: int) -> None:
        node, winner = (run + self.k) // 2, run
        while node > 0:
            if self.losers[node] < 0:
                self.losers[node] = winner
                return
            if self._beats(self.losers[node], winner):
                self.losers[node], winner = winner, self.losers[node]
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self._head(self.losers[0]) is not None:
            run = self.losers[0]
            yield self.runs[run][self.at[run]][1]
            self.at[run] += 1
            self._replay(run)


def merge_runs(entries: DataFrame, per_range: int = 20_000) -> DataFrame:
    """All runs merged into one global order: (range_no, seq) ascends with URL key and time.

    `capture_no` counts the captures of a URL key from 1.  Ranges are cut on the whole
    sort key, so one URL may span many of them; what reaches the driver is the last URL
    and its count per range.  A merging task holds the entries of one range.
    """
    spark = entries.sparkSession
    entries = cut(entries)
    ranges = max(2, -(-entries.count() // per_range))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs: list[list[tuple]] = []
        last = None
        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            for run, _, *entry in batch.itertuples(index=False, name=None):
                if run != last:
                    runs.append([])
                    last = run
                runs[-1].append((_order(tuple(entry)), tuple(entry)))
        number = TaskContext.get().partitionId()
        out, seq, capture, key = [], 0, 0, None
        for entry in LoserTree(runs):
            capture = capture + 1 if entry[0] == key else 1
            key = entry[0]
            out.append((number, seq, capture, *entry))
            seq += 1
            if len(out) == 20_000:
                yield _frame(out)
                out = []
        if out:
            yield _frame(out)

    fields = ["run", "ord", "url_key", "ts", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    merged = cut(entries.repartitionByRange(ranges, "url_key", "ts", "page_id", "run", "ord").sortWithinPartitions("run", "ord").select(*fields).mapInPandas(merge, MERGED))
    ends = merged.groupBy("range_no").agg(F.min("url_key").alias("first"), F.max(F.struct("url_key", "capture_no")).alias("last")).orderBy("range_no").collect()
    carry, open_key, so_far = [], None, 0
    for r in ends:
        if r["first"] == open_key:
            carry.append((r["range_no"], open_key, so_far))
        so_far = r["last"]["capture_no"] + (so_far if r["last"]["url_key"] == open_key else 0)
        open_key = r["last"]["url_key"]
    if not carry:
        return merged
    before = spark.createDataFrame(carry, "range_no long, url_key string, before long")
    return merged.join(F.broadcast(before), ["range_no", "url_key"], "left").withColumn("capture_no", F.col("capture_no") + F.coalesce("before", F.lit(0))).drop("before")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[x.split()[0] for x in MERGED.split(", ")])
    for c in ("page_id", "payload_bytes", "refers_to"):
        out[c] = out[c].astype("Int64")
    return out


def captures(pages: DataFrame, path: str | None = None, smallest: int = 100) -> DataFrame:
    """Archive pages, read the archives back and merge their index: one row per page.

    Pages without a `captured` time take the number of their page in seconds after 2024-01-01.
    An empty table gives no rows; repeated rows are records of their own.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    if "captured" not in pages.columns:
        pages = pages.withColumn("captured", F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.pmod("page_id", F.lit(10**9)), F.lit(0))))
    write_archives(pages.select("page_id", "url", "html", "captured"), path, smallest)
    return merge_runs(read_archives(spark, path))


@query(
    "op9_capture_histories",
    """WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
       o AS (SELECT payload_digest, min(page_id) AS owner FROM p WHERE payload_bytes >= 100 GROUP BY 1)
       SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN owner IS NULL OR owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
              CASE WHEN owner <> page_id THEN owner END AS refers_to
       FROM p LEFT JOIN o ON o.payload_digest = p.payload_digest""",
)
def op9(spark, sf):
    return captures(table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
