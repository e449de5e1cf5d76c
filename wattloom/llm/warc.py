"""WARC archives: written with Spark's text writer, read by a Python data source.

The reader plans its partitions from file sizes, takes predicates on the record type and on header values from Spark, parses a
record's headers first, and steps over payloads of records that the predicates reject or that the caller doesn't want.
"""

import gzip
import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull

from wattloom.llm.common import settle, small_enough, workers_import

CRLF = "\r\n"
#: Payloads under this many bytes are always written whole.
LEAST_REVISIT = 100
#: Digests that repeat and may be broadcast: about 40 bytes each.
DIGEST_ROWS = 200_000
DIGEST_PREFIX = "sha256:"
PAGE_URN = "urn:x-page:"
SCHEMA = ("record_id string, record_type string, target_uri string, date string, payload_digest string, payload_length long, "
          "refers_to string, headers map<string,string>, payload binary")
#: Columns on which Spark's predicates are pushed down, and the header each is read from.
PUSHED = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
          "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}


def records(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html",
            date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``(value)``: one WARC record per page, without the empty line that ends a record.

    Of pages with equal payloads of at least 100 bytes, those with the smallest id are responses; others revisit them. A null
    payload is empty. A null id is never the smallest; without any id in a group all its pages are responses. A null url leaves
    the target out; line breaks in a url are escaped. Equal rows give equal records; extra columns are ignored.
    """
    rows = pages.select(F.col(id_column).alias("_id"), F.col(url).alias("_url"), F.coalesce(F.col(html), F.lit("")).alias("_html"))
    rows = rows.withColumn("_bytes", F.octet_length("_html")).withColumn("_digest", F.sha2(F.encode("_html", "UTF-8"), 256))
    firsts = settle(rows.where(F.col("_bytes") >= LEAST_REVISIT).groupBy(F.unhex("_digest").alias("_key")).agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    joined = rows.join(small_enough(firsts, DIGEST_ROWS), F.unhex("_digest") == F.col("_key"), "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))

    def header(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit(CRLF))

    def urn(c: str) -> Column:
        return F.concat(F.lit(f"<{PAGE_URN}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF), header("Content-Type", "text/html; charset=utf-8"),
                    header("Content-Length", F.col("_bytes").cast("string")), F.lit(CRLF))
    block = F.when(revisit, http).otherwise(F.concat(http, "_html"))
    escaped = F.regexp_replace(F.regexp_replace("_url", "\r", "%0D"), "\n", "%0A")
    return joined.select(F.concat(
        F.lit("WARC/1.1" + CRLF), header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", urn("_id")), header("WARC-Date", date),
        F.coalesce(header("WARC-Target-URI", escaped), F.lit("")),
        header("WARC-Payload-Digest", F.concat(F.lit(DIGEST_PREFIX), "_digest")),
        header("X-Payload-Length", F.col("_bytes").cast("string")),
        F.when(revisit, F.concat(header("WARC-Refers-To", urn("_first")), header(
            "WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        header("Content-Type", "application/http;msgtype=response"),
        header("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block).alias("value"))


def write(pages: DataFrame, folder: str, **options) -> None:
    """Write the records of ``pages``; the text writer's line end is the pair of empty lines that ends a WARC record."""
    records(pages, **options).write.option("lineSep", CRLF * 2).text(folder)


def read(spark: SparkSession, folder: str, **options) -> DataFrame:
    """The records of all archives in a folder. Options: ``payload`` (false leaves payloads undecoded), ``partition_bytes``."""
    workers_import(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").options(**options).load(folder)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "WarcReader":
        return WarcReader(self.options)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.most = int(options.get("partition_bytes", 64 << 20))
        self.wanted: list[tuple[str, set]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality, lists and presence on header columns are settled by the reader; the rest stays with Spark."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name not in PUSHED:
                yield f
            elif isinstance(f, EqualTo | EqualNullSafe) and f.value is not None:
                self.wanted.append((name, {f.value}))
            elif isinstance(f, In):
                self.wanted.append((name, set(f.value) - {None}))
            elif isinstance(f, IsNotNull):
                self.wanted.append((name, set()))
            else:
                yield f

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("/") else self.path.replace(":", "://", 1))

    def partitions(self) -> list[Files]:
        """Files in order, put together up to ``partition_bytes``; a larger file stands alone."""
        from pyarrow import fs

        store, root = self._open()
        found = store.get_file_info(fs.FileSelector(root, recursive=True)) if store.get_file_info(root).type == fs.FileType.Directory \
            else [store.get_file_info(root)]
        out, room = [], 0
        for info in sorted((i for i in found if i.is_file and i.base_name[0] not in "._"), key=lambda i: i.path):
            if info.size == 0:
                continue
            if not out or info.size > room:
                out.append(Files([]))
                room = self.most
            out[-1].paths.append(info.path)
            room -= info.size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        store, _ = self._open()
        for path in partition.paths:
            with store.open_input_stream(path, compression=None, buffer_size=1 << 20) as raw:
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 20)
                yield from self._records(stream, path)

    def _records(self, stream, path: str) -> Iterator[tuple]:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{path}: a record starts with {line[:40]!r}")
            headers = _headers(stream)
            length = int(headers["content-length"])
            row = {c: headers.get(h) for c, h in PUSHED.items()}
            row["record_id"], row["refers_to"] = _bare(row["record_id"]), _bare(row["refers_to"])
            if any(row[c] is None or (values and row[c] not in values) for c, values in self.wanted):
                _skip(stream, length)
                continue
            payload = None
            if self.payload and row["record_type"] != "revisit":
                block = stream.read(length)
                if len(block) < length:
                    raise ValueError(f"{path}: the archive ends inside a record")
                http = headers.get("content-type", "").startswith("application/http")
                payload = block.partition(b"\r\n\r\n")[2] if http else block
            else:
                _skip(stream, length)
            stated = headers.get("x-payload-length")
            known = int(stated) if stated is not None else None if payload is None else len(payload)
            yield (row["record_id"], row["record_type"], row["target_uri"], row["date"], row["payload_digest"], known, row["refers_to"],
                   headers, payload)


def _headers(stream) -> dict[str, str]:
    """Header lines up to the empty one; a line that starts with a space goes on with the one before."""
    headers, last = {}, None
    while (line := stream.readline().decode("utf-8", "replace").rstrip("\r\n")):
        if line[0] in " \t" and last:
            headers[last] += " " + line.strip()
        else:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            headers[last] = value.strip()
    return headers


def _bare(uri: str | None) -> str | None:
    return uri[1:-1] if uri and uri[0] == "<" and uri[-1] == ">" else uri


def _skip(stream, length: int) -> None:
    while length > 0 and (piece := stream.read(min(length, 1 << 20))):
        length -= len(piece)


def page_digests(archive: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of records that ``write`` made, from what was read.

    A response's figures are taken from its payload, a revisit's from its headers.
    """
    def page(c: str) -> Column:
        return F.when(F.col(c) != PAGE_URN, F.substring(c, len(PAGE_URN) + 1, 40).cast("long"))

    own = F.col("payload").isNotNull()
    return archive.select(
        page("record_id").alias("page_id"),
        F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.replace("payload_digest", F.lit(DIGEST_PREFIX), F.lit(""))).alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"))


def digests_sql(pages: str = "pages") -> str:
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM {pages}),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f"""
