"""Coherent snapshots: labels and features of one set of source versions, published together and read back."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from urbanflow.operators import columns, quality
from urbanflow.sources import tables, versioned


class Captured(NamedTuple):
    """Versions of the sources and the frames that read exactly those, whatever is published later."""

    versions: dict[str, int]
    frames: dict[str, DataFrame]


def capture(spark: SparkSession, sources: Mapping[str, str], expected: Mapping[str, int] | None = None) -> Captured:
    """The newest version of each source.  Versions other than the expected ones are an error."""
    found = tables.capture_versions(spark, dict(sources))
    if expected is not None:
        stated = spark.createDataFrame(sorted(expected.items()), "table string, version int")
        if drift := quality.version_drift(stated, found).collect():
            raise ValueError(f"the sources aren't in the versions expected: {drift}")
    versions = {r["table"]: r["version"] for r in found.collect()}  # a row per source
    return Captured(versions, {name: versioned.read(spark, path, versions[name]) for name, path in sources.items()})


def build(captured: Captured, path: str, lineage: Mapping[str, str], make: Callable[[dict[str, DataFrame]], dict[str, DataFrame]], checks: Callable[[DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """Makes tables of the captured frames, publishes them below path and checks what was published.

    Lineage gets input_versions, the captured numbers as JSON.  A table whose counters (`checks`) aren't 0, or tables of
    different lineage, are errors.
    """
    own = {**lineage, "input_versions": json.dumps(captured.versions, sort_keys=True, separators=(",", ":"))}
    back = {}
    for name, df in make(captured.frames).items():
        at = f"{path}/{name}"
        back[name] = versioned.read(df.sparkSession, at, versioned.overwrite(columns.add_lineage(df, own), at))
        quality.require(checks(back[name]), name)
    kinds = quality.lineage_check(back, list(own)).collect()
    if len(kinds) != 1 or kinds[0]["has_null"]:
        raise ValueError(f"the tables have several lineages or one with a null: {kinds}")
    return back
