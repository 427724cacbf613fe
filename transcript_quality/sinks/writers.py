"""Writers.  Batch writes are whole-job commits (Spark's output committer), so a lost
executor re-runs its tasks without leaving partial files behind."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from transcript_quality.operators.partitioning import spread
from transcript_quality.schemas import FEATURE_HISTORY, GROUND_TRUTH, MANIFEST, REGISTRY, SCORED
from transcript_quality.session import settings
from transcript_quality.sources.tables import read_manifest
from transcript_quality.versions import publish


def _canonical(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


#: The name under which streams report their metrics.
RUN_METRICS = "run_metrics"


def history_metrics() -> dict[str, Column]:
    """Of feature rows: all, failed ones (NULL features), and those without a reference text (wer = -1)."""
    return {"rows": F.count(F.lit(1)), "failed": F.count_if(F.col("rms_db").isNull()), "unlabelled": F.count_if(F.col("wer") == -1.0)}


def truth_metrics() -> dict[str, Column]:
    """Of ground-truth rows: all, those without acoustics (audio that failed), and those without a hypothesis."""
    return {"rows": F.count(F.lit(1)), "failed": F.count_if(F.col("rms_db").isNull()),
            "skipped": F.count_if(F.coalesce("hypothesis_text", F.lit("")) == "")}


def manifest_metrics() -> dict[str, Column]:
    """Of manifest rows: all, and those without a reference text."""
    return {"rows": F.count(F.lit(1)), "unlabelled": F.count_if(F.coalesce("reference_text", F.lit("")) == "")}


def scored_metrics() -> dict[str, Column]:
    """Of SCORED rows: all, failed ones (status 500) and those to review."""
    return {"rows": F.count(F.lit(1)), "failed": F.count_if(F.col("status") != 200), "flagged": F.count_if("review_recommended")}


def observed(df: DataFrame, metrics: dict[str, Column], write: Callable[[DataFrame], object]) -> dict:
    """``write(df)`` and its run summary (AGG-14), observed on the way: no second pass over the data."""
    seen = Observation(f"run-{uuid.uuid4().hex}")
    write(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]))
    return dict(seen.get)


def append_features(df: DataFrame, path: str) -> dict:
    """SNK-1: append rows to the feature history in the canonical schema (float columns).  Returns the run summary (`history_metrics`)."""
    return observed(_canonical(df, FEATURE_HISTORY), history_metrics(), lambda rows: rows.write.mode("append").parquet(path))


def append_scores(df: DataFrame, path: str) -> dict:
    """Append SCORED rows; returns the run summary (`scored_metrics`)."""
    return observed(_canonical(df, SCORED), scored_metrics(), lambda rows: rows.write.mode("append").parquet(path))


def write_ground_truth(df: DataFrame, path: str) -> dict:
    """SNK-2: replace the ground-truth table by a new version (`versions`); ``sources.read_ground_truth`` reads it.  Returns the run summary (`truth_metrics`)."""
    return observed(_canonical(df, GROUND_TRUTH), truth_metrics(), lambda rows: publish(rows, path))


def write_manifest(df: DataFrame, path: str, based_on: int | None = None) -> dict:
    """SNK-3: manifest CSV with header (a directory of part files), as a new version (`versions`) that ``sources.read_manifest`` reads.
    ``df`` may be read from ``path``: older versions stay as they are.  Returns the run summary (`manifest_metrics`)."""
    csv = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return observed(_canonical(df, MANIFEST), manifest_metrics(), lambda rows: publish(rows, path, "csv", based_on, **csv))


def replace_manifest(df: DataFrame, path: str, based_on: int | None = None) -> DataFrame:
    """SNK-3 for an update in place, and a read of what was written.  With ``based_on``, the number of the version ``df`` was made from, a
    version that another job wrote in the meantime is a ``versions.Conflict`` and stays."""
    write_manifest(df, path, based_on)
    return read_manifest(df.sparkSession, path)


def write_files(df: DataFrame, folder: str, name: str = "path", content: str = "content") -> int:
    """Write each row's bytes as a file of its own below ``folder``, named by the last part of ``name``, and return the number of files.

    Tasks write them, each file under a hidden name first and then renamed, so a task that is run again replaces what it
    wrote and no half file is ever visible.  A table of few partitions is spread over the cores first.  Rows with the same name must hold the same bytes; NULL content is an empty file."""
    def run(batches):
        from pyarrow import fs
        files, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        files.create_dir(root, recursive=True)
        for b in batches:
            for file, data in zip(b["name"], b["content"], strict=True):
                part = f"{root}/_{uuid.uuid4().hex}"
                with files.open_output_stream(part) as out:
                    out.write(data or b"")
                files.move(part, f"{root}/{file}")
            yield b[["name"]]
    rows = df.select(F.element_at(F.split(F.col(name), "/"), -1).alias("name"), F.col(content).alias("content"))
    return spread(rows).mapInPandas(run, "name string").select("name").distinct().count()


JSON_ENTRIES_PER_PART = 20_000


def write_reference_lookup(df: DataFrame, path: str, as_json: bool = False,
                           entries_per_part: int = JSON_ENTRIES_PER_PART) -> None:
    """SNK-4: (filename, reference_text) as Parquet, or as JSON objects in the lookup's format: a folder
    ``part=<hash part>`` with one object of about ``entries_per_part`` entries each, so no task builds an unbounded
    map.  Of rows with the same filename one (the largest text) is kept.  A new version (`versions`)."""
    rows = df.select("filename", "reference_text").where(
        F.col("reference_text").isNotNull() & (F.col("reference_text") != ""))
    if not as_json:
        publish(rows, path)
        return
    rows = rows.groupBy("filename").agg(F.max("reference_text").alias("reference_text"))
    parts = rows.count() // entries_per_part + 1
    obj = rows.groupBy(F.pmod(F.xxhash64("filename"), F.lit(parts)).alias("part")).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("filename", "reference_text")))).alias("value"))
    publish(obj, path, "text", partition_by="part")


def save_model(model: PipelineModel, output_dir: str, ts: datetime | None = None) -> tuple[str, str]:
    """SNK-5: ``output_dir/v<yyyyMMdd_HHmmss_mmm>/model``; returns (version, path)."""
    ts = ts or datetime.now(timezone.utc)
    version = "v" + ts.strftime("%Y%m%d_%H%M%S_") + f"{ts.microsecond // 1000:03d}"
    path = f"{output_dir.rstrip('/')}/{version}/model"
    model.write().save(path)
    return version, path


def append_registry(df: DataFrame, path: str) -> None:
    _canonical(df, REGISTRY).write.mode("append").parquet(path)


def write_stream(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append", available_now: bool = True,
                 metrics: dict[str, Column] | None = None, conf: dict[str, str] | None = None):
    """SNK-7 / SNK-1: streaming append to a table that batch jobs append to as well.  Each micro-batch overwrites its own
    folder ``stream=<query id>/batch=<id>``: a retried batch replaces its rows, a new checkpoint (a new query id) never
    touches older rows, and no file log hides the files that others wrote.  With ``available_now`` the call
    waits until all input there is has been written.  ``metrics`` are observed in each micro-batch (`streaming.summaries`).
    ``conf`` holds session settings for the call (until the end with ``available_now``, else for the start)."""
    if metrics:
        df = df.observe(RUN_METRICS, *[c.alias(n) for n, c in metrics.items()])
    started, run = threading.Event(), []

    def write(rows: DataFrame, batch: int) -> None:
        started.wait()  # the first batch may come before start() returns; the id is the checkpoint's
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/stream={run[0]}/batch={batch}")

    w = df.writeStream.outputMode(output_mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    with settings(df.sparkSession, conf or {}):
        query = w.trigger(availableNow=True).start() if available_now else w.start()
        run.append(query.id)
        started.set()
        if available_now:
            query.awaitTermination()
    return query
