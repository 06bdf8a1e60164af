"""Stage tables that survive the run that made them: a restarted run reuses those that were finished.

A stage's identity is a fingerprint of its name, its parameters and the state of its inputs. Rows are written to a
folder of their own attempt, and a one-row record of that folder is committed behind them. Only folders named by
a record are ever read, so a run that dies while it writes leaves nothing that a later run could take for whole.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

RECORD = "data string, fingerprint string, n_rows long"


def input_state(spark: SparkSession, *paths: str) -> str:
    """A digest of the files under the paths: names, sizes and times. They are listed and summed by tasks."""
    states = []
    for path in sorted(paths):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        states.append([path, *map(str, files.agg(F.count("*"), F.sum(one)).first())])
    return _digest(states)


def _digest(value: object) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


@dataclass
class StageStore:
    """Finished stages under ``folder``, for inputs in the state that ``inputs`` names (see ``input_state``)."""

    spark: SparkSession
    folder: str
    inputs: str
    parameters: Mapping[str, object] = field(default_factory=dict)

    def fingerprint(self, name: str) -> str:
        return _digest([name, self.inputs, dict(self.parameters)])

    def _record_path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}/{self.fingerprint(name)[:24]}/record"

    def finished(self, name: str) -> DataFrame | None:
        """The stage's rows if a run has finished it, with as many rows as were written."""
        try:
            record = self.spark.read.schema(RECORD).json(self._record_path(name)).first()
        except AnalysisException:
            return None
        if record is None or record.fingerprint != self.fingerprint(name):
            return None
        return self.spark.read.parquet(record.data)

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The finished stage, or else ``build()`` written and committed."""
        known = self.finished(name)
        if known is not None:
            return known
        data = f"{self.folder.rstrip('/')}/{name}/{self.fingerprint(name)[:24]}/data-{uuid.uuid4().hex}"
        build().write.parquet(data)
        written = self.spark.read.parquet(data)
        record = self.spark.createDataFrame([(data, self.fingerprint(name), written.count())], RECORD)
        # One row in one file: it is there whole or not at all. A run beside this one may have finished too.
        record.coalesce(1).write.mode("overwrite").json(self._record_path(name))
        return written
