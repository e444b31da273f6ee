"""The same operators over message streams.

Event times must be ``timestamp`` columns (watermarks do not take zone-less
ones). Every function takes and returns streaming DataFrames; nothing here runs
until a sink is started.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.mime import to_messages
from ..operators.scoring import classify_rules, news_only
from ..operators.stories import extract_stories
from ..session import new_folder


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
    name_filter: str | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """New files under ``path`` as a stream; ``files_per_batch`` bounds one batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def ingest(
    export: DataFrame, classify: Callable[[DataFrame], DataFrame] = classify_rules, extract: Callable[[DataFrame], DataFrame] = extract_stories,
) -> DataFrame:
    """Stories of exported mail, row by row: headers and body, classification, news only, items. No state, so batches do not matter."""
    return extract(news_only(classify(to_messages(export))))


def drop_redelivered(stream: DataFrame, delay: str = "2 days", at: str = "received_at", key=("account", "message_id")) -> DataFrame:
    """First delivery of every message within ``delay``."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(key))


def window_counts(
    stream: DataFrame, by: str, at: str, size: str = "1 day", slide: str | None = None, delay: str = "1 hour"
) -> DataFrame:
    """Rows per window and ``by``; windows are emitted once, when the watermark passes them."""
    span = F.window(at, size, slide) if slide else F.window(at, size)
    return (
        stream.withWatermark(at, delay).groupBy(span.alias("span"), by).agg(F.count("*").alias("n"))
        .select(F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), by, "n")
    )


def sessions(stream: DataFrame, by: str, at: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Bursts of one sender separated by ``gap``."""
    return (
        stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("span"), by).agg(F.count("*").alias("n"))
        .select(F.col("span.start").alias("session_start"), F.col("span.end").alias("session_end"), by, "n")
    )


def sliced(df: DataFrame, at: str, slices: int) -> tuple[str, list[int]]:
    """(folder of the rows, written once by their slice number ``_slice``; the numbers in order): equal parts by ``at``, null times first."""
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    shares = [k / slices for k in range(1, slices)]
    cuts = (df.agg(F.percentile_approx(micros, shares, 10_000)).first()[0] or []) if shares else []
    number = F.lit(0)
    for cut in sorted(set(cuts)):
        number = number + F.coalesce(micros > cut, F.lit(False)).cast("int")
    folder = new_folder(df.sparkSession, "slices")
    df.withColumn("_slice", number).write.partitionBy("_slice").parquet(folder, compression="zstd")
    return folder, list(range(len(set(cuts)) + 1))


def replay(
    df: DataFrame, at: str, start: Callable[[DataFrame, str], None], slices: int = 2, closing: str | None = "4 days",
) -> None:
    """Feed a table to a streaming job in the order of ``at``, a slice per run, all runs on the job's one checkpoint.

    ``start(stream, folder)`` runs the job over what is available; it keeps its table and progress under
    ``folder``. Every slice is written and read by as many tasks as it needs, and its order does not hang on file
    times: the next slice is put into the inbox when the run before has ended. Rows without ``at`` come with the
    first slice. With ``closing`` the last slice also has a row with ``at`` that much after everything else and all
    else null. It moves the watermark past every window, so that windows still open when the input ends come out
    too; its own windows stay open and never do.
    """
    spark = df.sparkSession
    whole, numbers = sliced(df, at, slices)
    folder = new_folder(spark, "replay")
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place(f"{folder}/inbox"))
    for number in numbers:
        # The slice itself goes to the inbox, so that its rows lie on disk once.
        piece = place(f"{whole}/_slice={number}")
        if not files.exists(piece):
            df.limit(0).write.parquet(f"{folder}/inbox/{number}")
        elif not files.rename(piece, place(f"{folder}/inbox/{number}")):
            raise RuntimeError(f"{piece} could not be moved to the inbox")
        if closing and number == numbers[-1]:
            end = df.agg(F.max(at).alias(at)).select((F.col(at) + F.expr(f"INTERVAL {closing}")).alias(at))
            rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema if f.name != at]
            end.select(at, *rest).select(*df.columns).write.mode("append").parquet(f"{folder}/inbox/{number}")
        start(read_files(spark, f"{folder}/inbox/*", df.schema), folder)


def replayed_table(df: DataFrame, at: str, transform: Callable[[DataFrame], DataFrame], slices: int = 2, closing: str | None = "4 days") -> DataFrame:
    """What a stateful transformation of the stream has put into its table after :func:`replay`."""
    written = []

    def start(stream: DataFrame, folder: str) -> None:
        out = transform(stream)
        append_to_table(out, folder)
        written[:] = [out.schema, f"{folder}/table"]

    replay(df, at, start, slices, closing)
    return df.sparkSession.read.schema(written[0]).parquet(written[1])


def append_to_table(stream: DataFrame, folder: str) -> None:
    """Process what is available into ``folder/table``, with the progress beside it."""
    (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{folder}/table").option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True).start().awaitTermination()
    )


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Process what is available into a new table in the shared folder and read it."""
    spark = stream.sparkSession
    path = new_folder(spark, label)
    append_to_table(stream, path)
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def archive_batches(stream: DataFrame, path: str, progress: str, date_column: str = "digest_date"):
    """Append a stream to a dated archive so that a repeated batch changes nothing.

    Files are kept per date and batch number; a batch that runs again after a
    failure overwrites just its own files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(date_column, "batch_id").parquet(path)
        )

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )
