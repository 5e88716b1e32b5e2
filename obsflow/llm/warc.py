"""WARC archives: written as text records, read back by verifying the chain of record boundaries.

Writing: a group of equal payloads keeps one response record, the others become
revisit records that refer to it. Reading: the archives are split at every
occurrence of the version line, each giving a candidate record and the offset of
its successor (from its Content-Length). Candidates whose successor is the next
candidate form runs; pointer jumping over the runs from the start of each file
keeps the reachable ones, so a version line (or a whole record) inside a payload
is never taken for a record. A payload that holds such lines is put together
from its pieces. Offsets come from one written table of candidates, and a second
scan finds pieces by the hash of their bytes, so nothing depends on how a scan
happens to be split among the executors of the moment.

Rules: a null payload is empty; line breaks in a URL become spaces, a null URL
has no header; rows with a null id are written and read with a null id and never
chosen as response while another row has an id; copies that share the chosen id
are all responses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from obsflow.llm.common import stash

#: Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: 5 hex digits give 4 letters."""
    digits = F.sha1(payload)
    letters = []
    for i in range(8):
        v = F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 10).cast("int")
        letters += [F.substr(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def plan_records(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                 payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, record_type, refers_to): which page is a response and which a revisit."""
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                     F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    p = p.withColumn("key", F.unhex(F.sha2("payload", 256)))
    groups = (p.groupBy("key").agg(F.max("page_id").alias("chosen"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("key", "chosen"))
    groups = stash(groups, "warc-groups")
    again = ((F.octet_length("payload") >= min_bytes) & F.col("chosen").isNotNull()
             & ~F.col("page_id").eqNullSafe(F.col("chosen")))
    return (p.join(groups, "key", "left")
            .withColumn("record_type", F.when(again, F.lit("revisit")).otherwise(F.lit("response")))
            .withColumn("refers_to", F.when(again, F.col("chosen")))
            .select("page_id", "url", "payload", "record_type", "refers_to"))


def write_archives(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """One archive per partition of ``records`` under ``path``, through Spark's text writer."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", name("page_id")),
        F.lit(f"WARC-Date: {date}\r\n"),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " "))).otherwise(""),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", name("refers_to")),
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload").cast("binary")))),
        F.lit("Content-Type: text/html\r\n"),
        F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit(END))
    records.select(F.concat(head, body).alias("value")).write.option("lineSep", END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every version line, in file order (block, seq); a piece is what follows the line."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("seq"), F.col("value").cast("binary").alias("piece")))


def _piece_key() -> Column:
    return F.unhex(F.sha2("piece", 256))


def _candidates(pieces: DataFrame) -> DataFrame:
    """Header fields of every piece and, where its whole record is in the piece, the payload's size and digest."""
    text = F.col("piece").cast("string")
    head = F.substring_index(text, END, 1)
    field = lambda k: F.regexp_extract("head", rf"(?im)^{k}: *([^\r\n]*)", 1)
    page = lambda c: F.nullif(F.regexp_extract(c, r"<urn:page:([^>]*)>", 1), F.lit("")).try_cast("long")
    c = (pieces.withColumn("head", head).withColumn("bytes", F.octet_length("piece").cast("long"))
         .withColumn("head_bytes", F.octet_length("head").cast("long"))
         .withColumn("length", F.when(F.col("bytes") >= F.col("head_bytes") + 4, field("Content-Length").try_cast("long")))
         .withColumn("whole", F.coalesce(F.col("bytes") == F.col("head_bytes") + F.col("length") + 8, F.lit(False))))
    body = F.expr("substring(piece, cast(head_bytes + 5 as int), cast(length as int))")
    return c.select("file", "block", "seq", "bytes", "head_bytes", "length", "whole", _piece_key().alias("key"),
                    field("WARC-Type").alias("record_type"), page(field("WARC-Record-ID")).alias("page_id"),
                    page(field("WARC-Refers-To")).alias("refers_to"), field("WARC-Target-URI").alias("url"),
                    F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("named_digest"),
                    F.when(F.col("whole"), base32_sha1(body)).alias("digest"))


def _place(cand: DataFrame) -> DataFrame:
    """Offset ``o`` of every candidate in its file, and ``succ`` of its successor."""
    size = F.col("bytes") + len(MAGIC)
    blocks = cand.groupBy("file", "block").agg(F.sum(size).alias("total"))
    before = Window.partitionBy("file").orderBy("block")
    blocks = blocks.select("file", "block", (F.sum("total").over(before) - F.col("total")).alias("base"))
    inside = Window.partitionBy("file", "block").orderBy("seq")
    return (cand.join(blocks, ["file", "block"])
            .withColumn("o", F.col("base") + F.sum(size).over(inside) - size - len(MAGIC))
            .withColumn("succ", F.col("o") + len(MAGIC) + F.col("head_bytes") + 4 + F.col("length") + 4)
            .drop("base"))


def _reachable(placed: DataFrame) -> DataFrame:
    """The candidates on the chain from offset 0 of their file."""
    inside = Window.partitionBy("file", "block").orderBy("o")
    flow = placed.withColumn("joined", F.coalesce(F.lag("succ").over(inside) == F.col("o"), F.lit(False)))
    flow = flow.withColumn("runs_on", F.coalesce(F.lead("joined").over(inside), F.lit(False)))
    flow = stash(flow, "warc-flow")
    jumps = flow.where("not runs_on and succ is not null").select("file", F.col("succ").alias("o")).distinct()
    heads = flow.where("joined").join(jumps, ["file", "o"], "left_semi").select("file", "o", F.lit(True).alias("landed"))
    flow = flow.join(heads, ["file", "o"], "left").withColumn(
        "start", F.when(~F.col("joined") | F.coalesce("landed", F.lit(False)), F.col("o")))
    flow = stash(flow.withColumn("run", F.last("start", ignorenulls=True).over(inside)), "warc-runs")
    # one pointer per run: from its start to the successor of its last candidate
    jump = stash(flow.groupBy("file", "run").agg(F.max("o").alias("last"), F.max_by("succ", "o").alias("to"))
                 .where("to is not null").select("file", "run", "to"), "warc-jumps")
    reach = stash(flow.where("o = 0").select("file", F.col("o").alias("run")).distinct(), "warc-reach")
    n = reach.count()
    while True:
        step = reach.join(jump, ["file", "run"]).select("file", F.col("to").alias("run"))
        grown = stash(reach.unionByName(step).distinct(), "warc-reach")
        m = grown.count()
        if m == n:
            break
        reach, n = grown, m
        far = jump.withColumnRenamed("run", "a").withColumnRenamed("to", "run").join(jump, ["file", "run"])
        jump = stash(far.select("file", F.col("a").alias("run"), "to"), "warc-jumps")
    return flow.join(reach, ["file", "run"], "left_semi").drop("run", "start", "landed", "joined", "runs_on")


def _owners(placed: DataFrame, records: DataFrame) -> DataFrame:
    """(file, o, r, key): every candidate with the last record at or before it in its file."""
    real = records.select("file", "o", F.col("o").alias("own"))
    c = placed.select("file", "block", "o", "key").join(real, ["file", "o"], "left")
    c = stash(c, "warc-owners")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = c.groupBy("file", "block").agg(F.max("own").alias("top"))
    blocks = blocks.select("file", "block", F.max("top").over(before).alias("carried"))
    inside = Window.partitionBy("file", "block").orderBy("o")
    return (c.join(blocks, ["file", "block"])
            .withColumn("r", F.coalesce(F.last("own", ignorenulls=True).over(inside), "carried"))
            .select("file", "o", "r", "key"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest) of every record under ``path``.

    Size and digest of a revisit are those of the response it refers to.
    """
    candidates = stash(_candidates(_pieces(spark, path)), "warc-candidates")
    placed = stash(_place(candidates), "warc-placed").where("o >= 0")
    records = stash(_reachable(placed), "warc-records")
    cut = records.where("not whole and length is not null").select("file", F.col("o").alias("r"), "succ", "head_bytes", "length")
    if not cut.isEmpty():
        # payloads with a version line inside: their pieces, joined by the line, make the record again
        inner = (_owners(placed, records).join(cut.select("file", "r", F.col("succ").alias("r_end")), ["file", "r"])
                 .where("o < r_end").select("file", "r", "o", "key"))
        inner = stash(inner, "warc-inner")
        texts = (_pieces(spark, path).select(_piece_key().alias("key"), "piece")
                 .join(inner.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]))
        pieces = inner.join(texts, "key")
        whole = (pieces.groupBy("file", "r").agg(F.sort_array(F.collect_list(F.struct("o", "piece"))).alias("p"))
                 .withColumn("record", F.aggregate(
                     F.expr("slice(p, 2, size(p))"), F.expr("p[0].piece"),
                     lambda acc, x: F.concat(acc, F.lit(MAGIC).cast("binary"), x["piece"]))))
        mended = (whole.join(cut, ["file", "r"]).select("file", F.col("r").alias("o"), base32_sha1(
            F.expr("substring(record, cast(head_bytes + 5 as int), cast(length as int))")).alias("mended")))
        records = (records.join(mended, ["file", "o"], "left").withColumn("digest", F.coalesce("digest", "mended")))
    records = records.select("page_id", "url", "record_type", "refers_to", "named_digest",
                             F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"))
    first = records.where("record_type <> 'revisit'")
    source = first.where("page_id is not null").groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("b"))
    source = stash(source.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("named_digest"), "b"),
                   "warc-responses")
    back = (records.where("record_type = 'revisit'").join(source, ["refers_to", "named_digest"], "left")
            .select("page_id", "url", "record_type", "refers_to", F.col("b").alias("payload_bytes"),
                    F.col("named_digest").alias("payload_digest")))
    return first.select(*back.columns).unionByName(back)
