"""Steps of a run written as tables, so that a later run can go on from one; the last three are kept."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

STEPS = ("cleaned", "deduped", "filtered", "enriched", "decision_maker", "company_intel", "scored")
KEEP = 3


class Checkpoints:
    """Checkpoints of one run in a folder that all executors share: <step>_<n>/data and a manifest beside it."""

    def __init__(self, spark: SparkSession, folder: str, keep: int = KEEP):
        self.spark, self.folder, self.keep = spark, folder.rstrip("/"), keep

    def _path(self, p: str):
        q = self.spark._jvm.org.apache.hadoop.fs.Path(p)
        return q, q.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def list(self) -> list[str]:
        """The names of complete checkpoints, oldest first."""
        q, fs = self._path(f"{self.folder}/*/manifest.json")
        return sorted((s.getPath().getParent().getName() for s in (fs.globStatus(q) or [])), key=lambda n: int(n.rpartition("_")[2]))

    def save(self, df: DataFrame, step: str, stats: dict | None = None) -> str:
        if step not in STEPS:
            raise ValueError(f"no such step: {step}")
        have = self.list()
        name = f"{step}_{int(have[-1].rpartition('_')[2]) + 1 if have else 1}"
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}/data")
        q, fs = self._path(f"{self.folder}/{name}/manifest.json")
        out = fs.create(q, True)
        out.write(json.dumps({"step": step, "rows": self.spark.read.parquet(f"{self.folder}/{name}/data").count(), "stats": stats or {}}).encode())
        out.close()
        for old in self.list()[: -self.keep]:
            p, fs = self._path(f"{self.folder}/{old}")
            fs.delete(p, True)
        return name

    def load(self, name: str | None = None) -> tuple[DataFrame, str, dict] | None:
        """(rows, step, stats) of a checkpoint, by default the latest; None if there is none."""
        have = self.list()
        name = name or (have[-1] if have else None)
        if name not in have:
            return None
        text = self.spark.read.text(f"{self.folder}/{name}/manifest.json", wholetext=True).first()[0]
        m = json.loads(text)
        return self.spark.read.parquet(f"{self.folder}/{name}/data"), m["step"], m["stats"]

    def clear(self) -> None:
        p, fs = self._path(self.folder)
        fs.delete(p, True)
