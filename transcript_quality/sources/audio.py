"""Audio folder sources (batch, streaming) and the landed-file gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transcript_quality.schemas import AUDIO_FILES
from transcript_quality.session import path_exists


def read_audio(spark: SparkSession, path: str, glob: str = "*.wav", recursive: bool = True,
               min_size_kb: float | None = None) -> DataFrame:
    """SRC-1: recursive scan of audio files as binary rows.

    ``min_size_kb`` becomes a pushed-down ``length`` filter, so files that are too small are
    never opened.  Files are packed into splits by ``spark.sql.files.maxPartitionBytes``; no
    repartition of file bytes is needed."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", str(recursive).lower()).load(path))
    if min_size_kb is not None:
        df = df.where(F.col("length") >= F.lit(int(min_size_kb * 1024)))
    return df


def stream_audio(spark: SparkSession, path: str, glob: str = "*.wav", archive_dir: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-5 / SNK-6: newly landed audio as a stream.  The checkpoint of the consuming query
    makes every file count once; with ``archive_dir`` consumed files are moved there."""
    r = (spark.readStream.schema(AUDIO_FILES).format("binaryFile")
         .option("pathGlobFilter", glob).option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.load(path)


#: A file is reckoned as this many bytes more than it has when a micro-batch is dealt to tasks.  Spark's own 4 MB would make a task of every 32
#: short recordings.
FILE_COST = 256 << 10


def small_file_settings(spark: SparkSession) -> dict[str, str]:
    """Session settings for streams of many small files (``sinks.write_stream``): each task takes many of them, and so does each task that looks
    up a micro-batch's files (Spark's default is a task a file, up to 10,000 of them, in every micro-batch and at every restart)."""
    return {"spark.sql.files.openCostInBytes": str(FILE_COST),
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}


def enough_files(spark: SparkSession, path: str, min_files: int = 50, glob: str = "*.wav") -> bool:
    """SRC-6: True when at least ``min_files`` matching files have landed; missing folder ->
    False.  Only ``path`` is read (content is pruned) and the count stops at ``min_files``."""
    if not path_exists(spark, path):
        return False
    files = read_audio(spark, path, glob).select("path")
    return files.limit(min_files).count() >= min_files
