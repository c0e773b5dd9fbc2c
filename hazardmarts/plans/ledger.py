"""The finished stages of a run, with their small results, so that a run that ended half-way goes on from there.

The ledger is one line of JSON beside the tables. It holds for one set of inputs, told by a fingerprint: other inputs
start an empty one. A stage is entered when it is done; one that is cut short leaves no entry and is run again. The
ledger is cleared when the run is over.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession

from hazardmarts.sources import files


def fingerprint(*inputs: object) -> str:
    return hashlib.sha256(json.dumps(inputs, default=repr, sort_keys=True).encode()).hexdigest()


class Ledger:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.inputs: str | None = None
        self.done: dict[str, dict] = {}

    def begin(self, inputs: str, afresh: bool = False) -> None:
        """Take up what was done with the same inputs."""
        text = files.read_text(self.spark, self.path)
        known = json.loads(text) if text else {}
        self.inputs = inputs
        self.done = known["done"] if known.get("inputs") == inputs and not afresh else {}

    def finish(self, stage: str, result: dict) -> None:
        self.done[stage] = result
        files.write_text(self.spark, self.path, json.dumps({"inputs": self.inputs, "done": self.done}))

    def clear(self) -> None:
        files.remove(self.spark, self.path)
        self.done = {}
