"""Inputs from catalog tables or Parquet folders."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession

from ledgermend.sources.contracts import CONTRACTS, ROLE_CONTRACTS, ReconInputs, conform, rejects


def read_table(spark: SparkSession, location: str) -> DataFrame:
    """A Parquet file or folder if ``location`` holds a slash, else a catalog table."""
    return spark.read.parquet(location) if "/" in location else spark.table(location)


def _frames(spark: SparkSession, locations: Mapping[str, str]) -> dict[str, DataFrame]:
    """Each role's table as stored; roles that name the same location share one DataFrame."""
    unknown = set(locations) - set(ROLE_CONTRACTS)
    missing = set(ROLE_CONTRACTS) - set(locations)
    if unknown or missing:
        raise ValueError(f"unknown roles {sorted(unknown)}, missing roles {sorted(missing)}")
    stored = {location: read_table(spark, location) for location in set(locations.values())}
    return {role: stored[locations[role]] for role in ROLE_CONTRACTS}


def read_inputs(
    spark: SparkSession, locations: Mapping[str, str], strict: bool = True, observed: dict[str, Observation] | None = None
) -> ReconInputs:
    """Conforming inputs; ``locations`` names a table or path for every role.

    Roles that name the same location share one DataFrame if their contracts allow it. An unreadable number or date ends the run that needs it, or
    without ``strict`` counts as NULL (see ``conform``).

    Without ``strict``, ``observed`` is filled with an observation for each role that has a DataFrame of its own. After a run that uses the inputs,
    ``observed[role].get`` has the rows it read and the unreadable texts by column.
    """
    if strict and observed is not None:
        raise ValueError("a strict run has no unreadable texts to observe")
    frames = _frames(spark, locations)
    conforming: dict[tuple[str, str], DataFrame] = {}
    inputs = {}
    for role, contract in ROLE_CONTRACTS.items():
        # A frame of the location that has all fields of the contract serves it too.
        fields = set(CONTRACTS[contract])
        shared = [made for made in conforming if made[0] == locations[role] and fields <= set(CONTRACTS[made[1]])]
        source = shared[0] if shared else (locations[role], contract)
        if not shared:
            seen = None if observed is None else observed.setdefault(role, Observation(f"{role}-{uuid.uuid4().hex}"))
            conforming[source] = conform(frames[role], contract, strict, seen)
        inputs[role] = conforming[source]
    return ReconInputs(**inputs)


def read_rejects(spark: SparkSession, locations: Mapping[str, str]) -> DataFrame:
    """The unreadable texts of all inputs: role, column, text, count."""
    return rejects(_frames(spark, locations))
