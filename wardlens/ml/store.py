"""A store of fitted models: written once, published by one manifest, read by every later query and application.

A model's folder is named by a key of what it was made from: data fingerprint, task, sizes and inputs. An attempt writes the fitted
stages (MLlib's writer), the candidates' metrics and the held-out predictions below it, hashes the files, and
publishes ``manifest.json`` in one rename. Readers see a whole model or none; of two attempts at the same time
one is published and both read that one. Explanations are published the same way, next to the model that they were made from.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession

from wardlens.functions.files import damaged_files, exists, folder_digest, publish_text, read_text, remove
from wardlens.functions.scale import shared_dir
from wardlens.ml.models import Stacked, TrainedModel, Voting

FORMAT = 1  # of the folders below; part of every key
MANIFEST, EXPLANATION = "manifest.json", "explanation.json"
_LAST = {c.__name__: c for c in (GBTRegressionModel, LinearRegressionModel)}
_locks: defaultdict[str, threading.Lock] = defaultdict(threading.Lock)


def model_key(task: str, fingerprint: str, sizes: object, features: Sequence[str]) -> str:
    text = json.dumps([FORMAT, task, fingerprint, repr(sizes), list(features)])
    return f"{task}-{hashlib.sha256(text.encode()).hexdigest()[:24]}"


def _save(model: object, folder: str) -> dict:
    """Write a fitted model and describe how it is put together."""
    if isinstance(model, Voting):
        return {"kind": "voting", "members": [_save(m, f"{folder}/{k}") for k, m in enumerate(model.members)]}
    if isinstance(model, Stacked):
        bases = [_save(m, f"{folder}/{k}") for k, m in enumerate(model.bases)]
        return {"kind": "stacked", "bases": bases, "final": _save(model.final, f"{folder}/final")}
    model.write().save(folder)
    name = folder.rsplit("/model", 1)[-1]
    return {"kind": "pipeline" if isinstance(model, PipelineModel) else type(model).__name__, "folder": name}


def _load(parts: dict, folder: str) -> object:
    if parts["kind"] == "voting":
        return Voting([_load(m, folder) for m in parts["members"]])
    if parts["kind"] == "stacked":
        return Stacked([_load(m, folder) for m in parts["bases"]], _load(parts["final"], folder))
    kind = PipelineModel if parts["kind"] == "pipeline" else _LAST[parts["kind"]]
    return kind.load(f"{folder}{parts['folder']}")


@dataclass(frozen=True)
class Stored:
    """A published model's manifest and its folder."""

    spark: SparkSession
    folder: str
    manifest: dict

    @property
    def artifact(self) -> str:
        return f"{self.folder}/{self.manifest['attempt']}"

    @property
    def files(self) -> dict[str, str]:
        return self.manifest["files"]

    @property
    def artifact_hash(self) -> str:
        """One hash for all files of the artifact."""
        return hashlib.sha256(json.dumps(sorted(self.files.items())).encode()).hexdigest()

    def damage(self) -> Sequence[str]:
        """Files that are missing, added or changed since they were published."""
        found = folder_digest(self.spark, self.artifact) if exists(self.spark, self.artifact) else {}
        return damaged_files(self.files, found)

    def lineage(self) -> dict:
        """The registry's entry, judged against the files as they are now."""
        return {**self.manifest["lineage"], "artifact_hash": self.artifact_hash, "artifact_intact": not self.damage()}

    def read(self) -> TrainedModel:
        spark, m = self.spark, self.manifest
        holdout = spark.read.parquet(f"{self.artifact}/holdout") if m["holdout"] else None
        return TrainedModel(
            m["lineage"]["task"], _load(m["parts"], f"{self.artifact}/model"), spark.read.parquet(f"{self.artifact}/metrics"),
            m["lineage"], tuple(m["lineage"]["features"]), holdout,
        )

    def explain(self, report: Callable[[TrainedModel], DataFrame]) -> DataFrame:
        """The published explanation of this model; ``report`` makes it from the stored model if there is none yet."""
        path = f"{self.folder}/{EXPLANATION}"
        text = read_text(self.spark, path)
        if text is None:
            attempt = f"explanation-{uuid.uuid4().hex[:8]}"
            report(self.read()).coalesce(1).write.parquet(f"{self.folder}/{attempt}")
            files = folder_digest(self.spark, f"{self.folder}/{attempt}")
            made_from = {"attempt": attempt, "model_hash": self.artifact_hash, "files": files}
            publish_text(self.spark, path, json.dumps(made_from), attempt)
            text = read_text(self.spark, path)
        return self.spark.read.parquet(f"{self.folder}/{json.loads(text)['attempt']}")

    def explanation(self) -> dict | None:
        """Model hash that the explanation was made from, and whether its report is as published."""
        text = read_text(self.spark, f"{self.folder}/{EXPLANATION}")
        if text is None:
            return None
        made = json.loads(text)
        folder = f"{self.folder}/{made['attempt']}"
        found = folder_digest(self.spark, folder) if exists(self.spark, folder) else {}
        return {"model_hash": made["model_hash"], "report_intact": not damaged_files(made["files"], found)}


class ModelStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_dir(spark)}/wardlens-models"

    def find(self, key: str) -> Stored | None:
        text = read_text(self.spark, f"{self.root}/{key}/{MANIFEST}")
        return None if text is None else Stored(self.spark, f"{self.root}/{key}", json.loads(text))

    def publish(self, key: str, trained: TrainedModel) -> Stored:
        folder, attempt = f"{self.root}/{key}", f"attempt-{uuid.uuid4().hex[:8]}"
        parts = _save(trained.model, f"{folder}/{attempt}/model")
        trained.metrics.coalesce(1).write.parquet(f"{folder}/{attempt}/metrics")
        if trained.holdout is not None:
            trained.holdout.write.parquet(f"{folder}/{attempt}/holdout")
        manifest = {
            "key": key, "attempt": attempt, "parts": parts, "holdout": trained.holdout is not None, "lineage": trained.lineage,
            "files": folder_digest(self.spark, f"{folder}/{attempt}"),
        }
        if not publish_text(self.spark, f"{folder}/{MANIFEST}", json.dumps(manifest), attempt):
            remove(self.spark, f"{folder}/{attempt}")  # another attempt was first
        return self.find(key)

    def obtain(self, key: str, train: Callable[[], TrainedModel]) -> Stored:
        """The stored model, trained now if it is not there; threads that ask at the same time wait for one training."""
        with _locks[f"{self.root}/{key}"]:
            return self.find(key) or self.publish(key, train())
