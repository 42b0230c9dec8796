"""WARC archives, with an external merge of their indexes into globally ordered capture histories.

An archive has a gzip member for each record, so a record is read from its offset and length alone. Members are written by Spark's own text
writer, so archives can be in any store that Spark reaches: the writer ends each row with a zero byte, and a member of less than 16 MiB
of record ends with one (the highest byte of its length), which is left to the writer. A longer record is followed by an empty
member, which ends so too. Archives are read back as binary files and parsed member by member by Content-Length.

Each archive gives a locally sorted index run (URL key, time, record). Runs are dealt out by key ranges of at most about RANGE_ROWS rows; a
range's slices come one after another, sorted, are held as Arrow columns, and a k-way loser tree merges them.

Revisits: of records with equal payloads of at least min_payload bytes the one with the largest page id is the response.
That choice is an aggregate per digest (partial in each task). The groups of more than one record are joined back: broadcast where their counted
number is small, so that payloads stay where they are, else in salted parts.

Defined results: a null payload is empty; a null url has the key ""; empty and short payloads are always responses; a null page id
is never a winner and stays null; of repeated rows with the winning id one is the response as well as its copies (they refer to nothing); an empty table
gives no rows; further columns, whatever their names, are never read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import near, new_path, shuffle_partitions, written

END = "\r\n"
#: Parts of a group of equal payloads that are joined apart.
SALTS = 32
#: Rows of the index that a merge task should hold, rows of a run that it looks at together, rows of a batch of its result.
RANGE_ROWS, LOOK, BATCH = 500_000, 1024, 20_000


def url_key(url: Column) -> Column:
    """The sort-friendly key: host labels reversed, then the path: com,example,www)/path?query."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^([^/?]*)", 1), r":\d+$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(bare, r"^[^/?]*(.*)$", 1))


def decided(pages: DataFrame, *, id_col: str, url_col: str, payload_col: str, min_payload: int) -> DataFrame:
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload.cast("binary")).alias("digest"),
    )
    long = F.col("payload_bytes") >= min_payload
    kept = rows.filter(long).groupBy("digest").agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("n"))
    kept = written(kept.filter("n > 1").select("digest", "winner"), "warc-winners")
    salted = kept.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.when(long, F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")))
    joined = rows.join(near(salted, kept.count() * SALTS), ["digest", "salt"], "left")
    return joined.withColumn("refers_to", F.when(~F.col("winner").eqNullSafe(F.col("page_id")), F.col("winner"))).drop("winner", "salt")


def record(row_time: Column) -> Column:
    """A WARC/1.1 record as text. Revisits have no payload; both kinds name the full payload's digest and length."""
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = F.concat_ws(
        END, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", "")), F.concat(F.lit("WARC-Date: "), row_time),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")), F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to"), F.lit(">"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), F.octet_length(body)),
    )
    return F.concat(head, F.lit(END * 2), body, F.lit(END * 2))


def member(data: bytes) -> bytes:
    """A record as a gzip member (an empty one after it if it is long), which ends with a zero byte."""
    def packed(x: bytes) -> bytes:
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        return c.compress(x) + c.flush()

    return packed(data) if len(data) < 1 << 24 else packed(data) + packed(b"")


def write_archives(decided_pages: DataFrame, path: str, *, records_per_file: int = 5000) -> None:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = batch.column(0).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([member(x)[:-1] for x in records], pa.binary())], ["value"])

    time = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce(F.col("page_id"), F.lit(0)) % 100_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    members = decided_pages.select(record(time).alias("value")).mapInArrow(packed, "value binary").select(F.col("value").cast("string"))
    members.write.option("lineSep", "\0").option("maxRecordsPerFile", records_per_file).option("compression", "none").text(path)


INDEX = "url_key string, ts string, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, file string, at bigint, size bigint, run string"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split() for x in INDEX.split(", ")][: len(rows[0]) if rows else None]
    kinds = [pa.int64() if kind == "bigint" else pa.string() for _, kind in names]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [n for n, _ in names])


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member."""
    view, at, step = memoryview(data), 0, 1 << 16
    while at < len(data):
        one, out, end = zlib.decompressobj(31), [], at
        while not one.eof:
            fed = view[end : end + step]
            if not fed:
                raise ValueError(f"the archive ends within the member at {at}")
            out.append(one.decompress(fed))
            end += len(fed) - len(one.unused_data)
        yield at, end - at, b"".join(out)
        at = end


def parse(data: bytes) -> Iterator[dict]:
    """The records of an archive: head, body, at and size of the member. Empty members are passed over."""
    for at, size, raw in members(data):
        if not raw:
            continue
        end = raw.index(b"\r\n\r\n")
        lines = raw[:end].decode().split(END)
        head = dict(x.split(": ", 1) for x in lines[1:])
        start = end + 4
        stop = start + int(head["Content-Length"])
        if lines[0] != "WARC/1.1" or raw[stop:] != b"\r\n\r\n":
            raise ValueError(f"no WARC record at {at}")
        yield {"head": head, "body": raw[start:stop], "at": at, "size": size}


def _page(urn: str | None) -> int | None:
    found = re.search(r"urn:page:(-?\d+)", urn or "")
    return int(found[1]) if found else None


def read_index(spark, path: str) -> DataFrame:
    """The index of each archive, sorted: one run for each file."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for r in parse(content):
                    h = r["head"]
                    response = h["WARC-Type"] == "response"
                    length = len(r["body"]) if response else int(h["X-Payload-Length"])
                    digest = hashlib.sha1(r["body"]).hexdigest() if response else h["WARC-Payload-Digest"].removeprefix("sha1:")
                    rows.append((h.get("WARC-Target-URI", ""), h["WARC-Date"], _page(h["WARC-Record-ID"]), length, digest, h["WARC-Type"], _page(h.get("WARC-Refers-To")), name, r["at"], r["size"], name))
                yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    found = files.mapInArrow(runs, INDEX)
    return found.withColumn("url_key", url_key(F.col("url_key"))).sortWithinPartitions("run", "url_key", "ts", "page_id", "file", "at")


class LoserTree:
    """K-way merge of sorted runs: inner nodes hold the losers of their matches, so a step replays one path of log2(k) matches."""

    def __init__(self, runs: list[Iterator]) -> None:
        self.runs = runs
        self.k = len(runs)
        self.heads = [next(r, None) for r in runs]
        self.tree = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._replay(leaf)

    def _beats(self, a: int, b: int) -> bool:
        if a == -1 or b == -1:
            return a == -1
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.tree[node] == -1 and winner != -1:
                self.tree[node], winner = winner, -1  # waits for its match while the tree is built
            elif self._beats(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        if winner != -1 or self.k == 1:
            self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while self.k and self.heads[self.tree[0]] is not None:
            top = self.tree[0]
            yield self.heads[top]
            self.heads[top] = next(self.runs[top], None)
            self._replay_top(top)

    def _replay_top(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self._beats(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner


def merge_runs(index: DataFrame, rows: int) -> DataFrame:
    """The capture history, ordered over all parts by (url_key, ts, page_id); rows: about how many there are."""
    order = ["url_key", "ts", "page_id", "file", "at"]
    columns = [c for c in index.columns if c != "run"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches, arrow_schema).combine_chunks()
        if not held.num_rows:
            return
        run = held.column("run").combine_chunks().dictionary_encode()
        codes = (run.chunk(0) if isinstance(run, pa.ChunkedArray) else run).indices.to_numpy()
        edges = [0, *(i + 1 for i in (codes[1:] != codes[:-1]).nonzero()[0].tolist()), len(codes)]

        def keys(a: int, b: int) -> Iterator[tuple]:
            """A run's keys with their places, a few at a time."""
            for lo in range(a, b, LOOK):
                some = held.slice(lo, min(LOOK, b - lo))
                yield from zip(*([(x is not None, x) for x in some.column(c).to_pylist()] for c in order), range(lo, lo + some.num_rows), strict=True)

        out = held.select(columns)
        places: list[int] = []
        for key in LoserTree([keys(a, b) for a, b in zip(edges, edges[1:], strict=False)]):
            places.append(key[-1])
            if len(places) == BATCH:
                yield from out.take(places).combine_chunks().to_batches()
                places = []
        if places:
            yield from out.take(places).combine_chunks().to_batches()

    kinds = {"bigint": pa.int64(), "string": pa.string()}
    arrow_schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in INDEX.split(", ")])
    schema = ", ".join(x for x in INDEX.split(", ") if not x.startswith("run "))
    ranges = max(shuffle_partitions(index.sparkSession), -(-rows // RANGE_ROWS))
    return index.repartitionByRange(ranges, *order).sortWithinPartitions("run", *order).mapInArrow(merge, schema)


def archive(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_payload: int = 1000) -> DataFrame:
    """Writes the archives under path and returns their merged index."""
    write_archives(decided(pages, id_col=id_col, url_col=url_col, payload_col=payload_col, min_payload=min_payload), path)
    runs = written(read_index(pages.sparkSession, path), "warc-runs")
    return merge_runs(runs, runs.count())


def round_trip(pages: DataFrame) -> DataFrame:
    return archive(pages, new_path(pages.sparkSession, "warc"))
