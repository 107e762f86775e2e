"""A written log of the rounds of an iterative job, so that a stopped run can go on."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import SparkSession

from fairtally.storage import ChangedMeanwhile, Files

JOB = "job"


def exact_numbers(values: np.ndarray | None) -> list[list[str]] | None:
    """Doubles as texts that give the very same doubles back."""
    return None if values is None else [[float(v).hex() for v in row] for row in values]


@dataclass(frozen=True)
class Round:
    """The centers after a round, and what else it found; round 0 is the start."""

    number: int
    centers: np.ndarray
    facts: dict[str, float] = field(default_factory=dict)


class RoundLog:
    """Rounds of one job in a folder, a file each. Files appear whole or not at all."""

    def __init__(self, spark: SparkSession, folder: str, job: dict):
        self.files = Files(spark, folder)
        text = json.dumps(job, sort_keys=True)
        try:
            self.files.put(JOB, text)
        except ChangedMeanwhile:
            if self.files.read(JOB) != text:
                raise ValueError(f"{folder} holds the rounds of another job") from None

    def _numbers(self) -> list[int]:
        return sorted(int(n.split("-")[1]) for n in self.files.names() if n.startswith("round-"))

    def read(self, number: int) -> Round:
        known = json.loads(self.files.read(f"round-{number:06d}"))
        centers = np.array([[float.fromhex(v) for v in row] for row in known["centers"]])
        return Round(number, centers, {k: float.fromhex(v) for k, v in known["facts"].items()})

    def last(self, most: int) -> Round | None:
        """The last written round, of the first ``most``."""
        numbers = [n for n in self._numbers() if n <= most]
        return self.read(numbers[-1]) if numbers else None

    def append(self, done: Round) -> None:
        """A round that another run of the job wrote first stays as it is."""
        text = json.dumps({"centers": exact_numbers(done.centers), "facts": {k: float(v).hex() for k, v in done.facts.items()}})
        try:
            self.files.put(f"round-{done.number:06d}", text)
        except ChangedMeanwhile:
            pass
