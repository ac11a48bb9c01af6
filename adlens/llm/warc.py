"""Web archives: WARC records, and an index of captures merged from locally sorted runs.

Records are text (headers, an HTTP head and the page in UTF-8), so Spark's text writer makes the archives
and its committer survives lost executors. Records end with two line breaks; a page that holds the mark a record
starts with is sent in HTTP chunks cut inside that mark, so the archives are read as text again, record by
record, whatever a page says. `Content-Length` and the digest are checked on reading.

Of equal payloads the record with the smallest id is the response; the others revisit it and hold no payload.
Only payloads that a bitmap of fixed size marks as repeated are shuffled, and of those only the responses',
which an exact join of keys and ids finds first.

The index is an external merge: each task sorts the captures it read by URL key and time and writes this run
to the shared folder; ranges of the (key, time, id) order, whose bounds are taken from a sample, then gather
their part of every run and merge the runs by a loser tree. A host or URL with very many captures spans
several ranges. `range_no` and `position` number the captures in global order.

Defined cases: a null page is an empty payload; a null URL has no target header and an empty key; a line
break in a URL is percent-encoded; a null id never wins over others; rows that repeat the smallest id of
their payload are all responses; payloads below `least_bytes` are all responses; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.bitmap import bitmap_of, with_hint
from adlens.sources.materialise import materialise, shared_folder

#: The record start, its end, and the base-32 alphabet.
VERSION, END, BASE32 = "WARC/1.0\r\n", "\r\n\r\n", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
MARK = END + VERSION
RANGE_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def base32_sha1(body: Column) -> Column:
    """Bare upper-case base-32 SHA-1: each 5 hexadecimal digits are 4 letters."""
    digest, letters = F.sha1(body), []
    for part in range(8):
        number = F.conv(F.substring(digest, 5 * part + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(number, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*letters)


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then path and query: `org,example,www)/a?b`."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:www\.(?=[^/?#]*\.))?", "")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#:]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1)
    return F.when(rest == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path == "", "/").otherwise(path))
    )


def _chunked(payload: Column) -> Column:
    """The payload in HTTP chunks, cut inside every version mark."""

    def chunk(text: Column) -> Column:
        return F.concat(F.hex(F.octet_length(text)), F.lit("\r\n"), text, F.lit("\r\n"))

    return F.concat(F.array_join(F.transform(F.split(payload, r"(?<=W)(?=ARC/1\.0)"), chunk), ""), F.lit("0\r\n\r\n"))


def _record() -> Column:
    """The text of a record from `id`, `url`, `time`, `payload` (null: revisit), `bytes`, `digest`, `refers_to`."""
    marked = F.contains("payload", F.lit(VERSION.strip()))
    sent = F.when(F.col("payload").isNull(), "").when(marked, _chunked(F.col("payload"))).otherwise(F.col("payload"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.when(F.col("payload").isNotNull() & marked, F.lit("Transfer-Encoding: chunked\r\n")).otherwise(
            F.concat(F.lit("Content-Length: "), F.col("bytes").cast("string"), F.lit("\r\n"))
        ),
        F.lit("\r\n"),
    )

    def uri(number: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(number.cast("string"), F.lit("")), F.lit(">"))

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.col("payload").isNull()
    return F.concat(
        F.lit(VERSION),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", uri(F.col("id"))),
        header("WARC-Date", F.date_format(F.to_utc_timestamp("time", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        header("WARC-Target-URI", target),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        header("WARC-Refers-To", F.when(revisit, uri(F.col("refers_to")))),
        F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.0/identical-payload-digest\r\n").otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.lit("Content-Length: "),
        (F.octet_length(http) + F.octet_length(sent)).cast("string"),
        F.lit(END),
        http,
        sent,
    )


def write_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    time: Column | None = None,
    least_bytes: int = 0,
    path: str | None = None,
) -> str:
    """Write one record for each row of `pages` and return the folder of the gzip archives.

    Without a capture `time` it is the start of 2024 and as many seconds as the id says.
    """
    second = F.coalesce(F.pmod(F.col(f"`{id_col}`").cast("long"), F.lit(10**9)), F.lit(0))
    when = time if time is not None else F.timestamp_seconds(F.lit(1_704_067_200) + second)
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        when.alias("time"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("payload"),
    ).withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": base32_sha1(F.col("payload").cast("binary"))})
    keys = materialise(rows.filter(F.col("bytes") >= least_bytes).select("id", "bytes", "digest"), "keys")
    repeated = materialise(
        keys.groupBy("bytes", "digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"),
        "payloads",
    )
    groups = materialise(bitmap_of(repeated, [F.col("bytes"), F.col("digest")]), "repeated")
    # of the marked rows all that are responses, also those that the bitmap marks by chance
    marked = with_hint(keys, [F.col("bytes"), F.col("digest")], groups, "_again").filter("_again")
    kept = marked.join(repeated, ["bytes", "digest"], "left").filter("first IS NULL OR id <=> first")
    firsts = materialise(bitmap_of(kept, [F.col("digest"), F.col("id")]), "responses")
    hinted = with_hint(rows, [F.col("bytes"), F.col("digest")], groups, "_again")
    alone = hinted.filter("NOT _again").withColumn("refers_to", F.lit(None).cast("long")).drop("_again")
    # the payload of a row that is surely a revisit stays behind
    maybe = with_hint(hinted.filter("_again"), [F.col("digest"), F.col("id")], firsts, "_first")
    met = maybe.withColumn("payload", F.when(F.col("_first") | (F.col("bytes") < least_bytes), F.col("payload"))).join(
        repeated, ["bytes", "digest"], "left"
    )
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")) & (F.col("bytes") >= least_bytes)
    together = met.select(
        "id", "url", "time", F.when(~revisit, F.col("payload")).alias("payload"), "bytes", "digest", F.when(revisit, F.col("first")).alias("refers_to")
    )
    folder = path or f"{shared_folder(pages.sparkSession)}/warc-{uuid4().hex}"
    records = alone.select("id", "url", "time", "payload", "bytes", "digest", "refers_to").unionByName(together).select(_record().alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").text(folder)
    return folder


def _unchunked(body: Column) -> Column:
    """The payload of a chunked body; sizes count bytes, so the work is on binary."""
    state = F.struct(body.alias("rest"), F.lit("").cast("binary").alias("done"))
    # every chunk has two line breaks of its own
    turns = F.sequence(F.lit(1), F.size(F.split(F.decode(body, "ISO-8859-1"), "\r\n")))

    def turn(acc: Column, _: Column) -> Column:
        at = F.locate("\r\n", F.decode(F.substring(acc["rest"], 1, 20), "ISO-8859-1"))
        size = F.conv(F.decode(F.substring(acc["rest"], F.lit(1), at - 1), "ISO-8859-1"), 16, 10).cast("int")
        next_ = F.struct(
            F.substring(acc["rest"], at + size + 4, F.octet_length(acc["rest"])).alias("rest"),
            F.concat(acc["done"], F.substring(acc["rest"], at + 2, size)).alias("done"),
        )
        return F.when((at > 0) & (size > 0), next_).otherwise(acc)

    return F.aggregate(turns, state, turn, lambda acc: acc["done"])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """`id`, `url`, `time`, `record_type`, `refers_to`, `payload` (binary, null for revisits), `bytes`, `digest`, `archive`.

    A record that is cut short, or whose payload does not have the digest it names, is an error.
    """
    raw = spark.read.option("lineSep", MARK).text(folder).select("value", F.col("_metadata.file_name").alias("archive"))
    # the first record of an archive still has its start
    text = F.when(F.col("value").startswith(VERSION), F.substring(F.col("value"), len(VERSION) + 1, F.length("value"))).otherwise(F.col("value"))
    rows = raw.filter("value <> ''").withColumn("value", text)

    def after(source: str, mark: str) -> Column:
        """What follows the first `mark`."""
        return F.substring(F.col(source), F.locate(mark, F.col(source)) + len(mark), F.length(source))

    def field(source: str, name: str) -> Column:
        found = F.regexp_extract(F.col(source), rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
        return F.when(F.contains(F.col(source), F.lit(f"{name}: ")), found)

    def number(column: Column) -> Column:
        return F.nullif(F.regexp_extract(column, r"<urn:page:(.*)>", 1), F.lit("")).cast("long")

    rows = rows.select(
        "archive",
        F.substring_index("value", END, 1).alias("head"),
        after("value", END).cast("binary").alias("rest"),
    )
    length = field("head", "Content-Length").cast("int")
    rows = rows.withColumn("length", length).withColumn("block", F.substring(F.col("rest"), F.lit(1), F.col("length")))
    rows = rows.withColumn("_http", F.substring_index(F.decode(F.substring("block", 1, 4096), "ISO-8859-1"), END, 1))
    body = F.substring(F.col("block"), F.length("_http") + len(END) + 1, F.col("length"))
    chunked = F.contains("_http", F.lit("Transfer-Encoding: chunked"))
    kind = field("head", "WARC-Type")
    rows = rows.select(
        "archive",
        number(field("head", "WARC-Record-ID")).alias("id"),
        field("head", "WARC-Target-URI").alias("url"),
        F.from_utc_timestamp(F.to_timestamp(field("head", "WARC-Date"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.current_timezone()).alias("time"),
        kind.alias("record_type"),
        number(field("head", "WARC-Refers-To")).alias("refers_to"),
        F.substring_index(field("head", "WARC-Payload-Digest"), ":", -1).alias("named"),
        F.when(kind == "response", F.when(chunked, _unchunked(body)).otherwise(body)).alias("payload"),
        field("_http", "Content-Length").cast("long").alias("sent"),
        (F.octet_length("block") == F.col("length")).alias("whole"),
    )
    digest = F.coalesce(base32_sha1(F.col("payload")), F.col("named"))
    bad = ~F.col("whole") | (digest != F.col("named"))
    checked = F.when(bad, F.raise_error(F.lit("damaged archive record"))).otherwise(digest)
    return rows.select(
        "id", "url", "time", "record_type", "refers_to", "payload",
        F.coalesce(F.octet_length("payload").cast("long"), F.col("sent")).alias("bytes"),
        checked.alias("digest"), "archive",
    )


def merge_runs(runs: list[list]) -> Iterator:
    """The rows of sorted runs in one order, by a tree of losers; equal rows come in the order of the runs.

    Leaf k is run k. An inner node keeps the run that lost there, so after the winner moves on only the
    matches on its way to the root are played again.
    """
    k = len(runs)
    if k == 0:
        return
    at = [0] * k

    def beats(a: int, b: int) -> bool:
        if at[a] >= len(runs[a]) or at[b] >= len(runs[b]):
            return at[a] < len(runs[a]) or (at[b] >= len(runs[b]) and a < b)
        x, y = runs[a][at[a]], runs[b][at[b]]
        return x < y or (x == y and a < b)

    loser, winner = [0] * k, [0] * (2 * k)
    for node in range(2 * k - 1, 0, -1):
        if node >= k:
            winner[node] = node - k
        else:
            a, b = winner[2 * node], winner[2 * node + 1]
            winner[node], loser[node] = (a, b) if beats(a, b) else (b, a)
    best = winner[1]
    while at[best] < len(runs[best]):
        yield runs[best][at[best]]
        at[best] += 1
        node = (best + k) // 2
        while node:
            if beats(loser[node], best):
                best, loser[node] = loser[node], best
            node //= 2


def capture_index(records: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Captures in global order of `url_key`, `time` and `id`, with all columns of `records` but payload and url.

    `range_no` and `position` number them; a range holds about `range_rows` captures, which bounds a task.
    """
    named = records.drop("payload").withColumn("url_key", url_key(F.col("url"))).drop("url")
    order = [F.col("url_key"), F.col("time").asc_nulls_first(), F.col("id").asc_nulls_first()]
    runs = materialise(named.withColumn("run", F.spark_partition_id()).sortWithinPartitions(*order), "runs")
    # at least the session's number of partitions, more where ranges would get too long
    ranges = max(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // range_rows))
    spread = runs.repartitionByRange(ranges, *order, F.xxhash64("archive", "digest"))
    low = -(1 << 63)
    keyed = spread.select(
        "run", "url_key", F.coalesce(F.unix_micros("time"), F.lit(low)).alias("at"), F.coalesce("id", F.lit(low)).alias("number"),
        F.to_json(F.struct(*[c for c in runs.columns if c not in ("run", "url_key", "time")])).alias("rest"),
    )

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs_here: dict[int, list] = {}
        for frame in frames:
            for run, *row in frame.itertuples(index=False, name=None):
                runs_here.setdefault(run, []).append((row[0].encode(), *row[1:]))
        for part in runs_here.values():
            part.sort()  # linear where the shuffle kept the order of the run, as it does now
        place, batch = 0, []
        for row in merge_runs([runs_here[r] for r in sorted(runs_here)]):
            batch.append((row[0].decode(), row[1], row[3], place))
            place += 1
            if len(batch) == 10_000:
                yield _frame(batch)
                batch = []
        if batch:
            yield _frame(batch)

    def _frame(batch: list) -> pd.DataFrame:
        out = pd.DataFrame(batch, columns=["url_key", "at", "rest", "position"])
        out["range_no"] = TaskContext.get().partitionId()
        return out

    merged = keyed.mapInPandas(merge, "url_key string, at long, rest string, position long, range_no long")
    kept = [f for f in runs.schema.fields if f.name not in ("run", "url_key", "time")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    time = F.timestamp_micros(F.nullif(F.col("at"), F.lit(low))).alias("time")
    return merged.select("range_no", "position", "url_key", time, F.from_json("rest", schema).alias("_r")).select(
        "range_no", "position", "url_key", "time", "_r.*"
    )
