"""Stages that need not run again: a manifest tells which are complete for a run's inputs and settings."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from lociflow.sources import files
from lociflow.sources.sinks import log


def stage(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The rows of a complete stage of a run, by its manifest."""
    state = json.loads(files.read_text(spark, f"{folder.rstrip('/')}/resume.json") or "{}")
    return spark.read.parquet(state["stages"][name]["outputs"][0])


class Stages:
    """Stages of one run under a folder. A stage's rows are kept as Parquet under a name of the attempt's own, and count
    once the manifest, which is put in place as a whole, names them. When a stage runs, the stages after it run too, and
    the manifest forgets them before anything is written, so none is ever read beside inputs that it was not made from,
    wherever a run dies."""

    def __init__(
        self, spark: SparkSession, folder: str, settings: Mapping, inputs: Mapping[str, str | None], resume: bool = True
    ) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.payload = {
            "settings": dict(settings), "inputs": {k: self.file_signature(p) for k, p in sorted(inputs.items())}
        }
        self.signature = hashlib.sha1(json.dumps(self.payload, sort_keys=True, default=str).encode()).hexdigest()
        state = self._load() if resume else {}
        self.done: dict[str, dict] = state.get("stages", {}) if state.get("run_signature") == self.signature else {}
        self.notes: dict[str, object] = state.get("notes", {}) if self.done else {}
        self.fresh = False
        self._seen: set[str] = set()

    def file_signature(self, path: str | None) -> dict | None:
        """What a file, or all files of a folder, are known by, or None without a path."""
        return files.signature(self.spark, path) if path else None

    def _load(self) -> dict:
        try:
            return json.loads(files.read_text(self.spark, f"{self.folder}/resume.json") or "{}")
        except ValueError:
            return {}

    def _save(self) -> None:
        state = {
            "version": 2, "run_signature": self.signature, "signature_payload": self.payload, "stages": self.done,
            "notes": self.notes
        }
        files.put_text(self.spark, f"{self.folder}/resume.json", json.dumps(state, default=str))

    def note(self, name: str, make: Callable[[], object]) -> object:
        """A small value that belongs to the run, such as the samples' names: taken from the manifest, or made and put
        there."""
        if name not in self.notes:
            self.notes[name] = make()
            self._save()
        return self.notes[name]

    def path(self, name: str) -> str:
        """Where the rows of a complete stage are."""
        return self.done[name]["outputs"][0]

    def complete(self, name: str) -> bool:
        return not self.fresh and self.done.get(name, {}).get("completed", False) and files.exists(
            self.spark, f"{self.path(name)}/_SUCCESS"
        )

    def run(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if self.complete(name):
            self._seen.add(name)
            log.info("stage %s: taken from an earlier run", name)
            return self.spark.read.parquet(self.path(name))
        if not self.fresh:
            self.fresh = True
            self.done = {k: v for k, v in self.done.items() if k in self._seen}
            self._save()
        attempt = uuid.uuid4().hex[:12]
        path = f"{self.folder}/stages/{name}/{attempt}"
        make().write.parquet(path)
        self.done[name] = {"completed": True, "outputs": [path]}
        self._save()
        files.delete_others(self.spark, f"{self.folder}/stages/{name}", attempt)
        log.info("stage %s: done", name)
        return self.spark.read.parquet(path)
