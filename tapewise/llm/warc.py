"""WARC archives with revisit records, and their index merged from sorted capture runs.

*Writing.*  Every page becomes one WARC/1.1 record.  Of pages with equal
payloads of at least ``LEAST_REVISIT`` bytes the one with the largest page id
is a ``response``; the others are ``revisit`` records of the identical-payload
profile, with the HTTP header only.  Records are written by Spark's text
writer with the record separator as line separator, so archives are plain WARC
files (gzip-compressed as a whole), committed task by task in the shared
folder.

*Reading.*  Archives are read back with the binary-file source, decompressed
as a stream and cut by Content-Length, never by their contents; the digest of
every response payload is computed again from the bytes read.

*Index.*  Each archive gives a capture run, its records sorted by URL key and
timestamp.  Runs are dealt to key ranges; in each range a loser tree merges
the k runs.  Ranges split at (URL key, timestamp, page id), so a hot URL
spreads over several ranges, and (merge_range, merge_pos) is the global order
of the capture histories.

The capture time is ``EPOCH`` plus page_id seconds (pages carry no time).
Nulls: a null html is an empty payload, a null url has the empty key, a null
page_id sorts first, is written as ``-`` and only refers to others.  Repeated
rows are written each; equal payloads with the same largest id are all
responses.  An empty table gives empty archives and no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewise.llm.common import by_value, materialize, text_or_empty

LEAST_REVISIT = 1000
EPOCH = 1_577_836_800
RECORDS_PER_ARCHIVE = 20_000
RANGE_ROWS = 400_000
SEPARATOR = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = ("archive string, offset long, length long, page_id long, url string, captured_at string, record_type string, "
                 "payload_bytes long, payload_digest string, refers_to long, intact boolean")


def url_key(url: Column) -> Column:
    """SURT-like key: host labels reversed, then the path, without scheme, www, port or fragment, lower-cased."""
    bare = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://|#.*$", ""))
    host = F.regexp_replace(F.regexp_extract(bare, r"^([^/?]*)", 1), r"^www\d*\.|:\d+$", "")
    rest = F.regexp_extract(bare, r"^[^/?]*(.*)$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest))


def plan_records(pages: DataFrame) -> DataFrame:
    """The pages with their payload's size and digest, and the page whose response they refer to (null for responses)."""
    payload = text_or_empty("html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"))
    octets = rows.html.cast("binary")
    keys = rows.select("page_id", F.unhex(F.sha2(octets, 256)).alias("sha"), F.octet_length("html").alias("n"))
    large = keys.filter(F.col("n") >= LEAST_REVISIT)
    best = large.groupBy("sha").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    visits = large.join(best, "sha").filter(~F.col("page_id").eqNullSafe(F.col("top"))).select(
        F.col("page_id").alias("r_page"), F.col("top").alias("refers_to")).filter("refers_to is not null").distinct()
    visits = materialize(visits, "revisits")
    known = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("payload_digest", F.sha1(rows.html.cast("binary")))
    return known.join(visits, F.col("page_id").eqNullSafe(F.col("r_page")), "left").drop("r_page")


def record_text(refers: str = "refers_to") -> Column:
    """A record as text; the two line ends after it are the writer's separator."""
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    when = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.col(refers).isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
             F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")), F.concat(F.lit("WARC-Date: "), when),
             F.concat(F.lit("WARC-Target-URI: "), target), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
             F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col(refers).cast("string"), F.lit(">"))),
             F.lit("Content-Type: application/http; msgtype=response"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)


def write_archives(pages: DataFrame, path: str, records: int = RECORDS_PER_ARCHIVE) -> None:
    """Write one record per page; an archive holds at most ``records`` of them."""
    (plan_records(pages).select(record_text().alias("value")).write.option("lineSep", SEPARATOR)
     .option("maxRecordsPerFile", records).option("compression", "gzip").text(path))


class Reader:
    """The bytes of one archive, decompressed piece by piece."""

    def __init__(self, content: bytes, step: int = 1 << 20):
        self.content, self.step, self.at, self.offset = content, step, 0, 0
        self.inflate = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None
        self.held = bytearray()

    def fill(self, n: int) -> bool:
        while len(self.held) < n and self.at < len(self.content):
            piece = self.content[self.at:self.at + self.step]
            self.at += len(piece)
            while piece:
                if self.inflate is None:
                    self.held += piece
                    break
                self.held += self.inflate.decompress(piece)
                piece = self.inflate.unused_data
                if piece:  # the next member of the file
                    self.inflate = zlib.decompressobj(31)
        return len(self.held) >= n

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while True:
            found = self.held.find(mark, start)
            if found >= 0:
                return self.take(found + len(mark))
            start = max(0, len(self.held) - len(mark))
            if not self.fill(len(self.held) + 1):
                return None

    def take(self, n: int) -> bytes:
        self.fill(n)
        out = bytes(self.held[:n])
        del self.held[:n]
        self.offset += len(out)
        return out


def parse(name: str, content: bytes):
    """The records of an archive, as rows of RECORD_SCHEMA."""
    reader = Reader(content)
    while True:
        begin = reader.offset
        head = reader.until(b"\r\n\r\n")
        if head is None:
            return
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
        block = reader.take(int(fields["Content-Length"]))
        length = reader.offset - begin
        reader.take(4)
        http, _, payload = block.partition(b"\r\n\r\n")
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        number = fields["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")
        refers = fields.get("WARC-Refers-To")
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
        intact = kind == "revisit" or (len(payload) == size and hashlib.sha1(payload).hexdigest() == digest)
        yield (name, begin, length, None if number == "-" else int(number), fields.get("WARC-Target-URI", ""), fields["WARC-Date"], kind, size, digest,
               int(refers.removeprefix("<urn:page:").removesuffix(">")) if refers else None, intact)


def _records(frames):
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    for pdf in frames:
        for path, content in zip(pdf["path"], pdf["content"]):
            rows = list(parse(path.rsplit("/", 1)[-1], content))
            for a in range(0, len(rows), 5000):
                found = pd.DataFrame(rows[a:a + 5000], columns=names)
                yield found.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInPandas(_records, RECORD_SCHEMA)


class LoserTree:
    """Merge of k sorted runs: inner nodes hold the losers, so each step replays one path of log k comparisons."""

    def __init__(self, runs: list[list]):
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.losers = [0] * max(1, self.k)
        if self.k:
            self.winner = self._play(1)

    def _head(self, run: int):
        place = self.at[run]
        return self.runs[run][place] if place < len(self.runs[run]) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        return y is None or (x is not None and x <= y)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if not self._beats(a, b):
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self):
        while self.k and (head := self._head(self.winner)) is not None:
            yield head
            self.at[self.winner] += 1
            run, node = self.winner, (self.winner + self.k) >> 1
            while node:
                if not self._beats(run, self.losers[node]):
                    run, self.losers[node] = self.losers[node], run
                node >>= 1
            self.winner = run


def _merge(frames, columns: list[str]):
    """Merge the runs of one key range; its rows arrive run by run, each run sorted."""
    from pyspark import TaskContext

    held = [f for f in frames if len(f)]
    if not held:
        return
    pdf = pd.concat(held, ignore_index=True)
    ids = pdf["page_id"].fillna(-1).astype("int64")
    heads = list(zip(pdf["url_key"], pdf["captured_at"], ids, range(len(pdf))))
    starts = [0, *(pdf.index[pdf["archive"].ne(pdf["archive"].shift())][1:]), len(pdf)]
    order = [h[3] for h in LoserTree([heads[a:b] for a, b in zip(starts, starts[1:])])]
    out = pdf.iloc[order].reset_index(drop=True)
    out.insert(0, "merge_pos", range(len(out)))
    out.insert(0, "merge_range", TaskContext.get().partitionId())
    for a in range(0, len(out), 10_000):
        yield out.iloc[a:a + 10_000][columns]


def merge_index(records: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The index of all archives in global (URL key, time, page id) order, merged from the archives' sorted runs."""
    runs = records.withColumn("url_key", url_key(F.col("url"))).sortWithinPartitions("archive", "url_key", "captured_at", "page_id")
    ranges = max(1, -(-records.count() // range_rows))
    dealt = (runs.repartitionByRange(ranges, "url_key", "captured_at", "page_id")
             .sortWithinPartitions("archive", "url_key", "captured_at", "page_id"))
    schema = "merge_range int, merge_pos long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)
    columns = [x.split()[0] for x in schema.split(", ")]
    return dealt.mapInPandas(lambda frames: _merge(frames, columns), schema)


def capture_index(pages: DataFrame, path: str) -> DataFrame:
    """Write the archives, read them back and merge their index; a record that does not read back intact is an error."""
    write_archives(pages, path)
    records = materialize(read_archives(pages.sparkSession, path), "warc-records")
    merged = merge_index(records)
    checked = F.when(F.col("intact"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("an archived payload does not match its digest")))
    return merged.withColumn("payload_digest", checked)


by_value(__name__)
