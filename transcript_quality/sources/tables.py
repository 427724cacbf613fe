"""Table sources: reference lookup JSON, feature history, manifest CSV, models."""

from __future__ import annotations

import logging

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transcript_quality.schemas import FEATURE_HISTORY, GROUND_TRUTH, MANIFEST, REFERENCE_LOOKUP
from transcript_quality.session import path_exists
from transcript_quality.versions import resolve

log = logging.getLogger(__name__)


def read_reference_lookup(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: ``{filename: text}`` JSON objects (a file, or a folder with one object a file) -> (filename,
    reference_text) rows; a Parquet lookup is read directly.  Missing path -> warning and an empty lookup."""
    if not path_exists(spark, path):
        log.warning("Reference lookup not found at %s", path)
        return spark.createDataFrame([], REFERENCE_LOOKUP)
    path = resolve(spark, path) or path
    if _is_parquet(spark, path):
        return spark.read.schema(REFERENCE_LOOKUP).parquet(path)
    doc = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), "map<string,string>")
    return doc.select(F.explode(m).alias("filename", "reference_text"))


def _is_parquet(spark: SparkSession, path: str) -> bool:
    """A ``.parquet`` path, or a folder holding Parquet part files."""
    if path.rstrip("/").endswith(".parquet"):
        return True
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.getFileStatus(hpath).isDirectory():
        return False
    return any(st.getPath().getName().endswith(".parquet") for st in fs.listStatus(hpath))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: feature history (file or directory) in the canonical schema, with everything that batch and
    streaming runs appended below it; missing path raises."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Feature history not found: {path}")
    return spark.read.schema(FEATURE_HISTORY).option("recursiveFileLookup", True).parquet(path)


def read_manifest(spark: SparkSession, path: str, require_rows: bool = False) -> DataFrame:
    """SRC-4: manifest CSV with header and the explicit MANIFEST schema."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Manifest not found at {path}")
    path = resolve(spark, path) or path
    df = spark.read.schema(MANIFEST).option("header", True).option("multiLine", True) \
        .option("escape", '"').csv(path)
    if require_rows and df.limit(1).count() == 0:
        raise ValueError(f"Manifest is empty: {path}")
    return df


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the ground-truth table; missing path raises."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Ground truth not found: {path}")
    return spark.read.schema(GROUND_TRUTH).parquet(resolve(spark, path) or path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """SRC-7: load a saved pipeline model; missing path raises."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Model not found at {path}")
    return PipelineModel.load(path)
