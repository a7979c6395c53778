"""Ad-click text records: ``epoch_ms province city userid adid``.

One parsing function serves a batch DataFrame of lines and a Structured
Streaming source alike (it is a stateless projection plus filter), so the
stream needs no state store and scales with the number of input partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELDS = ["click_ms", "province", "city", "user_id", "ad_id"]

LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])


def _parts_sql(value: str = "value") -> str:
    return f"split({value}, ' ')"


def with_parsed(lines: DataFrame) -> DataFrame:
    """Adds typed columns and ``valid``: exactly five space-separated parts,
    all whole numbers."""
    split = lines.selectExpr("value", f"{_parts_sql()} AS parts")
    cols = [f"try_cast(try_element_at(parts, {i + 1}) AS BIGINT) AS {name}"
            for i, name in enumerate(FIELDS)]
    parsed = split.selectExpr("value", "size(parts) AS n_parts", *cols)
    all_numbers = " AND ".join(f"{c} IS NOT NULL" for c in FIELDS)
    return parsed.withColumn("valid", F.expr(f"coalesce(n_parts = 5 AND {all_numbers}, false)"))


_PARSED_COLUMNS = ["click_ms",
                   "date_format(timestamp_millis(click_ms), 'yyyy-MM-dd HH:mm:ss') AS click_time",
                   "province", "city", "user_id", "ad_id"]


def parse_ad_clicks(lines: DataFrame) -> DataFrame:
    """Valid records as typed rows; ``click_time`` is the UTC text time."""
    return with_parsed(lines).where("valid").selectExpr(*_PARSED_COLUMNS)


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not valid records."""
    return with_parsed(lines).where("NOT valid").select("value")


def format_ad_clicks(rows: DataFrame) -> DataFrame:
    """Typed rows -> one ``value`` text column, the inverse of the parser."""
    return rows.selectExpr(
        "concat_ws(' ', " + ", ".join(f"CAST({c} AS STRING)" for c in FIELDS) + ") AS value")


def ad_clicks_from_events(events: DataFrame) -> DataFrame:
    """Typed ad-click rows derived from ``events``: province and city from
    the user id's last digit, user id modulo 100, ad id from the event id."""
    return events.selectExpr(
        "unix_millis(CAST(ts AS TIMESTAMP)) AS click_ms",
        "user_id % 10 AS province", "user_id % 10 AS city",
        "user_id % 100 AS user_id", "event_id % 20 AS ad_id")


TAGGED_COLUMNS = [*_PARSED_COLUMNS, "value"]


def write_tagged_batch(lines: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch, valid records and rejected lines alike, to
    ``path/batch_id=<n>/valid=<true|false>``: the batch is evaluated once. A batch
    that is run again replaces its own folder, so the table holds every line once.
    Valid records have their typed columns, every row its ``value``."""
    # both kinds of a file's lines stay in its task: no shuffle
    (with_parsed(lines).selectExpr("valid", *TAGGED_COLUMNS).write.mode("overwrite")
     .partitionBy("valid").parquet(f"{path.rstrip('/')}/batch_id={int(batch_id)}"))


def read_tagged(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid records, rejected lines) of a table of tagged batches, each with its
    ``batch_id``; only the folders of one kind are read."""
    schema = ("click_ms long, click_time string, province long, city long, user_id long, ad_id long,"
              " value string, batch_id long, valid boolean")
    rows = spark.read.schema(schema).parquet(path)
    return (rows.where("valid").drop("valid", "value"),
            rows.where("NOT valid").select("batch_id", "value"))


def start_tagged_stream(spark: SparkSession, source_dir: str, path: str, checkpoint: str,
                        available_now: bool = True, interval: str = "1 second"):
    """Stream text files into a table of tagged batches (:func:`write_tagged_batch`),
    valid records and rejected lines in one evaluation of each micro-batch."""
    lines = spark.readStream.schema(LINE_SCHEMA).text(source_dir)
    writer = (lines.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, n: write_tagged_batch(batch, n, path)))
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime=interval)).start()


def start_parse_stream(spark: SparkSession, source_dir: str, sink_dir: str,
                       checkpoint: str, available_now: bool = True,
                       rejects_dir: str | None = None, interval: str = "1 second"):
    """Stream text files from ``source_dir``, parse them, append the valid
    records as parquet to ``sink_dir``. Progress is kept under ``checkpoint``,
    a shared folder of this stream's own, so a restarted query resumes where it
    stopped. Without ``available_now`` a micro-batch starts every ``interval``.

    With ``rejects_dir`` each micro-batch is split into valid records and
    rejected lines, written under ``batch_id=<n>`` folders of two places with
    overwrite, so a retried batch replaces its own output instead of adding
    to it. The batch is parsed once and kept for the second write;
    :func:`start_tagged_stream` needs one write only. Returns the running
    ``StreamingQuery``.
    """
    lines = spark.readStream.schema(LINE_SCHEMA).text(source_dir)
    if rejects_dir is None:
        writer = (parse_ad_clicks(lines).writeStream.format("parquet").outputMode("append")
                  .option("path", sink_dir))
    else:
        def write_batch(batch: DataFrame, batch_id: int) -> None:
            tagged = with_parsed(batch).persist()
            (tagged.where("valid").selectExpr(*_PARSED_COLUMNS)
             .write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}"))
            (tagged.where("NOT valid").select("value")
             .write.mode("overwrite").parquet(f"{rejects_dir.rstrip('/')}/batch_id={batch_id}"))
            tagged.unpersist()
        writer = lines.writeStream.foreachBatch(write_batch)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=interval)
    return writer.start()
