"""The column registry: small configuration that drives the loads."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a release."""

    name: str
    role: str  # "s" sample, "m" measurement
    datatype: str  # contains "number", "text" or "catalogue"
    catalogue: str = "0"  # "0" means none
    identifier: bool = False
    core_sample: bool = False
    core_measurement: bool = False


@dataclass(frozen=True)
class Registry:
    specs: tuple[ColumnSpec, ...]

    def __post_init__(self):
        bad = sorted({s.role for s in self.specs} - {"s", "m"})
        if bad:
            raise ValueError(f"role must be 's' or 'm', found {bad}")
        names = [s.name for s in self.specs]
        if len(set(names)) != len(names):
            raise ValueError("a column may be registered only once")

    def _names(self, keep) -> list[str]:
        return [s.name for s in self.specs if keep(s)]

    @property
    def datatypes(self) -> dict[str, str]:
        return {s.name: s.datatype for s in self.specs}

    @property
    def ids(self) -> dict[str, int]:
        """Column name -> id, in the order of registration."""
        return {s.name: i for i, s in enumerate(self.specs, 1)}

    @property
    def catalogues(self) -> dict[str, str]:
        """Core sample column -> catalogue, for the columns that have one."""
        return {s.name: s.catalogue for s in self.specs if s.core_sample and s.catalogue != "0"}

    @property
    def identifiers(self) -> list[str]:
        return self._names(lambda s: s.identifier)

    @property
    def sample_columns(self) -> list[str]:
        return self._names(lambda s: s.role == "s")

    @property
    def core_sample_columns(self) -> list[str]:
        return self._names(lambda s: s.role == "s" and s.core_sample)

    @property
    def rest_sample_columns(self) -> list[str]:
        return self._names(lambda s: s.role == "s" and not s.core_sample and not s.identifier)

    @property
    def core_measurement_columns(self) -> list[str]:
        return self._names(lambda s: s.role == "m" and s.core_measurement)

    @property
    def rest_measurement_columns(self) -> list[str]:
        return self._names(lambda s: s.role == "m" and not s.core_measurement)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The registry as a table."""
        rows = [(self.ids[s.name], s.name, s.role, s.datatype, s.catalogue) for s in self.specs]
        return spark.createDataFrame(rows, "id int, columnname string, sample_measurement string, datatype string, catalogue string")


def read_registry_csv(path: str, sep: str = ",") -> list[dict[str, str]]:
    """The rows of a registry file.  It is configuration, which shapes the schema, so the driver reads it."""
    with open(path, newline="", encoding="utf-8-sig") as file:
        return [{(k or "").strip().lower(): v for k, v in row.items()} for row in csv.DictReader(file, delimiter=sep)]


def _text(row: Mapping, name: str) -> str:
    return str("" if row.get(name) is None else row[name]).strip().lower()


def _flag(row: Mapping, name: str) -> bool:
    text = _text(row, name)
    if text not in ("", "0", "1", "0.0", "1.0"):
        raise ValueError(f"{name} must be 0 or 1, found {text!r}")
    return text in ("1", "1.0")


def registry_from(rows: Iterable[Mapping]) -> Registry:
    """Build the registry from its rows; texts are lower-cased and stripped first."""
    specs = []
    for row in rows:
        if not _text(row, "columnname"):
            raise ValueError("a registered column needs a name")
        specs.append(ColumnSpec(
            _text(row, "columnname"), _text(row, "sample_measurement"), _text(row, "datatype"), _text(row, "catalogue") or "0",
            *[_flag(row, flag) for flag in ("unique_identifier", "core_sample", "core_measurement")],
        ))
    return Registry(tuple(specs))


@dataclass(frozen=True)
class AmrColumn:
    """One column of an antimicrobial-resistance release."""

    name: str  # name in the release
    merge: str | None  # name shared by columns that hold the same thing
    db_name: str  # name in the warehouse
    catalogue: str | None
    order: int
    drop: bool

    @property
    def merged_name(self) -> str:
        return self.merge or self.name


@dataclass(frozen=True)
class AmrRegistry:
    columns: tuple[AmrColumn, ...]

    @property
    def kept(self) -> list[str]:
        return [c.name for c in self.columns if not c.drop]

    @property
    def merges(self) -> dict[str, str]:
        return {c.name: c.merge for c in self.columns if c.merge and c.merge != c.name}

    @property
    def merged(self) -> list[AmrColumn]:
        """One entry per merged name, the first one registered, in output order."""
        first: dict[str, AmrColumn] = {}
        for c in self.columns:
            first.setdefault(c.merged_name, c)
        return sorted(first.values(), key=lambda c: c.order)

    @property
    def catalogues(self) -> dict[str, str]:
        return {c.merged_name: c.catalogue.lower() for c in self.merged if c.catalogue}


def amr_registry_from(rows: Iterable[Mapping]) -> AmrRegistry:
    """The same for antimicrobial-resistance releases; blank cells are missing, order and ``drop`` are numbers."""
    return AmrRegistry(tuple(
        AmrColumn(r["columnname"], r.get("merge") or None, r["columnname_db"], r.get("catalogue") or None, int(float(r["volgorde"])), _flag(r, "drop"))
        for r in rows
    ))
