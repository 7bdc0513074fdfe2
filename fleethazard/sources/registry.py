"""Versioned models with metadata and an ACTIVE pointer, on any file system Spark can write.

A save writes a folder of its own and then a commit record, which can be created once. Until the record is there the
version does not exist; from then on nothing changes it. Two writers, or a crash between the two steps, never mix
a model with another's metadata.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fleethazard.session import create_file, replace_file

# fixed values: the keys of the metadata contract
REQUIRED = ("model_type", "featureset_version", "horizon_n", "window_l", "feature_columns", "threshold", "bucket_cutoffs",
            "target_recall", "min_precision", "val_metrics")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _read_text(spark: SparkSession, path: str) -> str:
    try:
        return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()).strip()
    except AnalysisException as error:
        raise FileNotFoundError(path) from error


def checksum(spark: SparkSession, folder: str) -> str:
    """A hash over the names and contents of all files in a folder, each hashed where it is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    inside = F.substring_index("path", folder.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
    rows = files.select(inside.alias("name"), F.sha2("content", 256).alias("sha")).collect()  # files of a model
    lines = sorted(f"{r['sha']} {r['name']}" for r in rows if not r["name"].rsplit("/", 1)[-1].startswith(("_", ".")))
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def set_active_version(spark: SparkSession, name: str, version: str, root: str) -> None:
    """Point ACTIVE at a version; one that isn't committed can't be loaded."""
    replace_file(spark, f"{root}/{name}/ACTIVE", version.encode())


def get_active_version(spark: SparkSession, name: str, root: str) -> str:
    return _read_text(spark, f"{root}/{name}/ACTIVE")


def check_metadata(metadata: dict) -> None:
    missing = [k for k in REQUIRED if k not in metadata]
    if missing:
        raise ValueError(f"metadata misses {missing}")
    if not 0.0 <= metadata["threshold"] <= 1.0:
        raise ValueError("metadata threshold must be in [0, 1]")
    cutoffs = metadata["bucket_cutoffs"]
    if len(cutoffs) != 2 or not 0.0 <= cutoffs[0] < cutoffs[1] <= 1.0:
        raise ValueError("metadata bucket_cutoffs must be two increasing values in [0, 1]")


def write_attempt(spark: SparkSession, name: str, version: str, model: PipelineModel, metadata: dict, root: str) -> tuple[str, str]:
    """(folder, checksum) of a model and its metadata, written under the version but not yet part of it."""
    check_metadata(metadata)
    attempt = uuid.uuid4().hex
    folder = f"{root}/{name}/{version}/{attempt}"
    model.save(f"{folder}/model")
    _write_text(spark, f"{folder}/metadata", json.dumps(metadata, sort_keys=True))
    return attempt, checksum(spark, folder)


def save_model_version(spark: SparkSession, name: str, version: str, model: PipelineModel, metadata: dict, root: str,
                       set_active: bool = True) -> str:
    """The folder of the new version; FileExistsError if another save has committed it, which is then untouched."""
    attempt, digest = write_attempt(spark, name, version, model, metadata, root)
    create_file(spark, f"{root}/{name}/{version}/COMMIT", json.dumps({"folder": attempt, "checksum": digest}).encode())
    if set_active:
        set_active_version(spark, name, version, root)
    return f"{root}/{name}/{version}/{attempt}"


def load_model_version(spark: SparkSession, name: str, version: str, root: str) -> tuple[PipelineModel, dict]:
    """Model and metadata of a committed version; ValueError if its files are not those that were committed."""
    commit = json.loads(_read_text(spark, f"{root}/{name}/{version}/COMMIT"))
    folder = f"{root}/{name}/{version}/{commit['folder']}"
    if checksum(spark, folder) != commit["checksum"]:
        raise ValueError(f"{folder} differs from what was committed")
    metadata = json.loads(_read_text(spark, f"{folder}/metadata"))
    check_metadata(metadata)
    return PipelineModel.load(f"{folder}/model"), {**metadata, "version": version}


def load_active_model(spark: SparkSession, name: str, root: str) -> tuple[PipelineModel, dict]:
    """Model and metadata of the ACTIVE version; raises if none is active."""
    return load_model_version(spark, name, get_active_version(spark, name, root), root)
