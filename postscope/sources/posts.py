"""Post sources: live raw feed (S1), archive as batch (S2) or stream (S3),
archive record decode with defaults (S4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import normalise, valid_posts
from ..functions.tagging import track_filter
from ..functions.time import event_time
from ..schema import DEFAULTS, POST, RETWEET
from ..session import settings
from ..vocab import DEFAULT_TAGS


def live_raw(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded feed of raw JSON posts, one per line, from a landing folder.

    Any streaming DataFrame with a ``value`` string column (Kafka, socket,
    rate source) can be passed to :func:`live_posts` instead.
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(landing)


def live_posts(raw: DataFrame, tags: Sequence[str] = DEFAULT_TAGS, track: Sequence[str] | None = None,
               time_mode: str = "event", with_errors: bool = False) -> DataFrame:
    """Raw feed -> English post records with an event-time column ``t``.

    ``track`` keeps only posts mentioning a term (the upstream filter of the
    original feed). ``time_mode='event'`` uses ``createdAt``; ``'ingest'``
    stamps rows with the processing time instead.
    """
    if track:
        raw = raw.where(track_filter("value", track))
    n = normalise(raw, "value", tags)
    posts = n if with_errors else valid_posts(n)
    t = event_time("createdAt") if time_mode == "event" else F.current_timestamp()
    return posts.withColumn("t", t)


def _decode(df: DataFrame) -> DataFrame:
    """Absent fields take the record defaults."""
    cols = []
    for f in POST.fields:
        if f.name == "retweet":
            rt = []
            for g in RETWEET.fields:
                d = "" if isinstance(g.dataType, T.StringType) else 0
                rt.append(F.coalesce(F.col(f"retweet.{g.name}"), F.lit(d).cast(g.dataType)).alias(g.name))
            cols.append(F.struct(*rt).alias("retweet"))
        else:
            cols.append(F.coalesce(F.col(f.name), F.lit(DEFAULTS[f.name]).cast(f.dataType)).alias(f.name))
    extra = [c for c in df.columns if c not in POST.fieldNames()]
    return df.select(*cols, *extra)


def archive_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Archive lines parsed against the whole record: ``_p`` (the record), ``_raw`` and ``error``.

    Which lines are good never depends on the columns a query uses: the full
    schema is always parsed, and a broken line or a field of the wrong type
    marks the line. Blank lines are no records.
    """
    schema = T.StructType([*POST.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    extra = [c for c in lines.columns if c != value]
    parsed = lines.where(F.trim(F.col(value)) != "").select(
        *extra, F.col(value).alias("_raw"), F.explode(F.array(F.from_json(F.col(value), schema, options))).alias("_p"))
    bad = F.col("_p").isNull() | F.col("_p._corrupt_record").isNotNull()
    return parsed.withColumn("error", F.when(bad, F.lit("malformed archive line")))


def archive_posts(parsed: DataFrame) -> DataFrame:
    """Good lines of :func:`archive_lines` as post records (plus partition columns)."""
    extra = [c for c in parsed.columns if c not in ("_p", "_raw", "error")]
    return _decode(parsed.where(F.col("error").isNull()).select(*[F.col(f"_p.{n}").alias(n) for n in POST.fieldNames()], *extra))


def archive_quarantine(parsed: DataFrame) -> DataFrame:
    """Rejected lines of :func:`archive_lines`: ``raw`` and ``error`` (plus partition columns)."""
    extra = [c for c in parsed.columns if c not in ("_p", "_raw", "error")]
    return parsed.where(F.col("error").isNotNull()).select(*extra, F.col("_raw").alias("raw"), "error")


def archive_text(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Raw archive lines. Default: bucket directories are discovered as a
    ``bucket`` partition column, so filters on it prune directories;
    ``recursive=True`` reads every file below ``path`` as plain files."""
    r = spark.read.format("text")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    # an archive has many small folders: list them in a few tasks per core, not in one task each
    with settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}):
        return r.load(path)


def read_archive(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """The JSON-lines archive as a batch DataFrame of post records; the
    lines it leaves out are those of :func:`read_archive_quarantine`."""
    return archive_posts(archive_lines(archive_text(spark, path, recursive)))


def read_archive_quarantine(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    return archive_quarantine(archive_lines(archive_text(spark, path, recursive)))


def stream_archive(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                   rejected: bool = False) -> DataFrame:
    """S3: the archive read as a stream (one pass over existing files, then new
    ones); ``rejected=True`` streams its quarantined lines instead."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    parsed = archive_lines(r.load(path))
    return archive_quarantine(parsed) if rejected else archive_posts(parsed)


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table read as a file stream (schema from the batch read)."""
    batch = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    r = spark.readStream.schema(batch.schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(sf_dir)
