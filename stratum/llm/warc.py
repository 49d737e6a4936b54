"""WARC archives: writing with deduplicated payloads, reading by boundary chain.

Writing. Every page is a WARC/1.1 record. Pages with equal payloads of at least
``min_bytes`` are one ``response`` (the least page_id) and ``revisit`` records
that name it; digests, not payloads, are shuffled for that. Spark's text writer
writes the records, with the two line breaks that end a record as its line
separator, so files are committed by task and lie wherever Spark can write.

Reading. The text reader splits files at the magic ``WARC/1.1\\r\\n``. A place
where it stands is a candidate only, as payloads may hold it too. Each task gives
every candidate's offset (from the lengths of the pieces before it) and, from its
header, the offset at which the next record must begin. Pointer jumping from the
start of each file follows these successors, doubling its step in every round;
candidates that it does not reach lie inside payloads and are rejected. A record
whose payload holds the magic is put together from its pieces. For that the texts
of its file are written once more, with offsets of their own: numbers of pieces
differ from scan to scan with the executors at hand, offsets in a file do not. A chain that does
not end at the end of the file (damaged archive) keeps the records up to the break.

Defined cases: a null payload is empty. Control characters and spaces in urls are
percent-encoded, a null url is left out. Rows that repeat a page_id: all rows with
the least id of their payload are responses. A null page_id is never the least of
a payload that has others; records of null ids carry no id. Payloads are UTF-8
strings and may hold the magic, line breaks and whole records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import discard, new_path, written

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_ID = "urn:page:"


def _sql_text(s: str) -> str:
    return "'" + s.replace("\r", "\\r").replace("\n", "\\n") + "'"


def write_warc(pages: DataFrame, path: str, payload: str = "html", min_bytes: int = 100,
               date: str = "2024-01-01T00:00:00Z", max_records: int = 10_000, compression: str | None = "gzip") -> None:
    """Write a record for each row of ``pages`` (page_id, url, payload) below
    ``path``. A file holds at most ``max_records`` records, since a compressed one
    is read by one task; without compression, files are read in splits."""
    rows = pages.select("page_id", "url", F.coalesce(payload, F.lit("")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    # only payloads that occur again: one row for each digest of several ids
    firsts = (rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1").drop("n"))
    twice = written(rows.where(F.col("size") >= min_bytes).select("page_id", "digest").join(firsts, "digest")
                    .where("first IS NOT NULL AND NOT (page_id <=> first)").select(
                        F.col("page_id").alias("p"), F.col("digest").alias("d"), "first").distinct(), "warc-revisits")
    rows = rows.join(twice, rows["page_id"].eqNullSafe(twice["p"]) & (rows["digest"] == twice["d"]), "left").drop("p", "d")
    url = F.expr("regexp_replace(url, '[\\\\x00-\\\\x20\\\\x7f]', '%20')")
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    revisit = F.col("first").isNotNull()
    block = F.when(revisit, F.lit(_HTTP)).otherwise(F.concat(F.lit(_HTTP), "payload"))
    record = F.concat(
        F.lit(MAGIC),
        F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        line("WARC-Record-ID", F.concat(F.lit(f"<{_ID}"), F.col("page_id").cast("string"), F.lit(">"))),
        line("WARC-Target-URI", url),
        F.lit(f"WARC-Date: {date}\r\n"),
        line("WARC-Refers-To", F.concat(F.lit(f"<{_ID}"), F.col("first").cast("string"), F.lit(">"))),
        line("X-Payload-Length", F.when(revisit, F.col("size").cast("string"))),
        line("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("WARC-Payload-Digest: sha256:"), "digest", F.lit("\r\n"),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)
    rows.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", max_records).text(
        path, compression=compression or "none")
    discard(twice)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The texts between the magics, in each split of a file in order."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("nth"), F.col("value"))


def _parsed(piece: str) -> dict:
    """Header fields of a record whose text behind the magic is ``piece``, and its
    payload, by SQL functions on the text's bytes."""
    head = f"substring_index({piece}, {_sql_text(END)}, 1)"

    def field(name: str) -> str:
        return f"nullif(regexp_extract(concat('\\r\\n', {head}, '\\r\\n'), '\\r\\n{name}: *([^\\r\\n]*)\\r\\n', 1), '')"

    return {
        "head_bytes": f"octet_length({head}) + 4L",
        "length": f"try_cast({field('Content-Length')} AS bigint)",
        "type": field("WARC-Type"), "id": field("WARC-Record-ID"), "url": field("WARC-Target-URI"), "refers": field("WARC-Refers-To"),
        "stood_bytes": f"try_cast({field('X-Payload-Length')} AS bigint)",
        "stood_digest": f"regexp_replace({field('WARC-Payload-Digest')}, '^sha256:', '')",
    }


def chain(candidates: DataFrame) -> DataFrame:
    """(file, at) of the candidates (file, at, next) that can be reached from
    offset 0 of their file. Round k adds the records 2**k steps on; as a
    successor always lies further on, none comes twice."""
    spark = candidates.sparkSession
    hops = written(candidates.where("next > at").select("file", "at", "next"), "hops", few=True)
    known = candidates.select("file", "at")
    reached = written(known.where("at = 0"), "reached", few=True)
    while True:
        more = written(reached.join(hops, ["file", "at"]).select("file", F.col("next").alias("at")), "more", few=True)
        if more.isEmpty():
            discard(hops)
            # a successor at which no candidate stands (the end of the file) is none
            return reached.join(known, ["file", "at"], "left_semi")
        reached = reached.unionAll(more)
        twice = written(hops.join(hops.select("file", F.col("at").alias("next"), F.col("next").alias("then")), ["file", "next"])
                        .select("file", "at", F.col("then").alias("next")), "hops", few=True)
        discard(hops)
        hops = twice


def _placed(pieces: DataFrame) -> DataFrame:
    """``pieces`` (a written table: file, split, nth, size, ...) with ``at``, the
    offset of the magic before each. Pieces tile a split, splits tile a file; what
    stands before a file's first magic is left out."""
    magic = len(MAGIC)
    spans = pieces.groupBy("file", "split").agg(F.sum(F.col("size") + magic).alias("bytes"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    base = spans.select("file", "split", F.coalesce(F.sum("bytes").over(before(Window.partitionBy("file").orderBy("split"))), F.lit(0)).alias("base"))
    within = F.coalesce(F.sum(F.col("size") + magic).over(before(Window.partitionBy("file", "split").orderBy("nth"))), F.lit(0))
    return (pieces.withColumn("within", within).join(base, ["file", "split"])
            .withColumn("at", F.col("base") + F.col("within") - magic).where("at >= 0").drop("base", "within"))


def _payload(body: str) -> dict:
    """Size and digest of the payload behind the block's HTTP header, if it has one."""
    head = f"substring_index(cast({body} AS string), {_sql_text(END)}, 1)"
    payload = (f"CASE WHEN startswith(cast({body} AS string), 'HTTP/') AND octet_length({head}) < octet_length({body}) "
               f"THEN substring({body}, octet_length({head}) + 5) ELSE {body} END")
    return {"payload_bytes": f"cast(octet_length({payload}) AS bigint)", "payload_digest": f"sha2({payload}, 256)", "payload": payload}


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records below ``path``: file, offset, type, id, url, refers,
    payload_bytes, payload_digest (SHA-256, hex) and, with ``payloads``, the
    payload. Size and digest of a revisit are those of the payload it stands for,
    as its header names them."""
    # the first pass keeps lengths, header fields and the digest of what a piece holds, but no payload
    body = ("CASE WHEN length >= 0 AND octet_length(value) >= head_bytes + length "
            "THEN substring(cast(value AS binary), int(head_bytes) + 1, int(length)) END")
    fields = {k: F.expr(e) for k, e in _parsed("value").items()}
    pieces = _pieces(spark, path)
    if payloads:
        pieces = written(pieces, "warc-texts")
    light = pieces.withColumn("size", F.octet_length("value").cast("long")).withColumns(fields).withColumn("body", F.expr(body))
    light = written(light.select(
        "file", "split", "nth", "size", *fields, F.col("body").isNotNull().alias("whole"),
        *[F.expr(e).alias(k) for k, e in _payload("body").items() if k != "payload"]), "warc-pieces")
    placed = written(_placed(light).withColumn("next", F.when(F.col("length") >= 0, F.col("at") + len(MAGIC) + F.col("head_bytes") + F.col("length") + len(END))),
                     "warc-candidates")
    discard(light)
    records = written(chain(placed).withColumn("reached", F.lit(True)).join(placed, ["file", "at"], "right"), "warc-records")
    discard(placed)
    true = records.where("reached AND type IS NOT NULL AND length >= 0")
    plain = ["file", F.col("at").alias("offset"), "type", "id", "url", "refers"]
    out = [*plain, F.when(F.col("type") == "revisit", F.col("stood_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
           F.when(F.col("type") == "revisit", F.col("stood_digest")).otherwise(F.col("payload_digest")).alias("payload_digest")]
    if payloads:
        held = pieces.join(true.where("whole").drop("size"), ["file", "split", "nth"]).withColumn("body", F.expr(body))
        one = held.select(*out, F.expr(_payload("body")["payload"]).alias("payload"))
    else:
        one = true.where("whole").select(*out)
    torn = true.where("NOT whole").select("file", F.col("at").alias("record"))
    if torn.isEmpty():
        return one
    if not payloads:
        pieces = written(_pieces(spark, path).join(torn.select("file").distinct(), "file", "left_semi"), "warc-texts")
    # a record whose payload holds the magic owns the pieces up to the next true record
    owner = F.max(F.when(F.col("reached"), F.col("at"))).over(Window.partitionBy("file").orderBy("at"))
    parts = records.withColumn("record", owner).select("file", F.col("at").alias("piece_at"), "record").join(torn, ["file", "record"])
    numbers = _placed(pieces.select("file", "split", "nth", F.octet_length("value").cast("long").alias("size"))).drop("size").withColumnRenamed("at", "piece_at")
    texts = (pieces.join(numbers.join(parts, ["file", "piece_at"]), ["file", "split", "nth"]).groupBy("file", F.col("record").alias("at"))
             .agg(F.array_sort(F.collect_list(F.struct("piece_at", "value"))).alias("pieces"))
             .withColumn("value", F.expr(f"array_join(transform(pieces, p -> p.value), {_sql_text(MAGIC)})")).drop("pieces"))
    # a damaged last record is cut short: it has no whole payload and is left out
    joined = texts.join(true.drop("payload_bytes", "payload_digest"), ["file", "at"]).withColumn("body", F.expr(body)).where("body IS NOT NULL")
    joined = joined.withColumns({k: F.expr(e) for k, e in _payload("body").items()})
    return one.unionByName(joined.select(*out, *(["payload"] if payloads else [])))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written and read back."""
    path = new_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    number = f"cast(nullif(regexp_extract(%s, '{_ID}(-?[0-9]+)', 1), '') AS bigint)"
    return read_warc(spark, path).select(
        F.expr(number % "id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.expr(number % "refers").alias("refers_to"))


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha256(h) AS s FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY s) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, s AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
