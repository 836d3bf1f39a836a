"""What a run has finished, so that a restarted one need not do it again."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from vigia.sources.files import read_text, stamp, write_text

FOLDER = "_manifest"


@dataclass(frozen=True)
class Manifest:
    """A small file for each finished item below ``<root>/_manifest``, written as a whole after the item's output.

    It proves the item as long as the settings are the same and neither its inputs nor its outputs have been written since, by
    their stamps (files, bytes, time of the commit).  An item that was broken off has no file, and its stage does it again.
    """

    spark: SparkSession
    root: str
    settings: str

    def _path(self, stage: str, item: str) -> str:
        name = re.sub(r"[^0-9A-Za-z_]", "_", f"{stage}-{item}")
        return f"{self.root.rstrip('/')}/{FOLDER}/{name}.json"

    def _stamps(self, paths: Sequence[str]) -> dict[str, str | None]:
        return {path: stamp(self.spark, path) for path in paths}

    def proves(self, stage: str, item: str, inputs: Sequence[str]) -> list[tuple] | None:
        """The audit rows of an item that is done, or ``None``."""
        text = read_text(self.spark, self._path(stage, item))
        if text is None:
            return None
        known = json.loads(text)
        if known["settings"] != self.settings or known["inputs"] != self._stamps(inputs):
            return None
        if known["outputs"] != self._stamps(list(known["outputs"])):
            return None
        return [tuple(row) for row in known["audit"]]

    def record(self, stage: str, item: str, inputs: dict[str, str | None], outputs: Sequence[str], audit: Sequence[tuple]) -> None:
        """Notes an item whose inputs had these stamps when it began."""
        content = {"settings": self.settings, "inputs": inputs, "outputs": self._stamps(outputs), "audit": [list(row) for row in audit]}
        write_text(self.spark, self._path(stage, item), json.dumps(content))

    def begin(self, inputs: Sequence[str]) -> dict[str, str | None]:
        return self._stamps(inputs)
