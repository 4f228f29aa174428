"""The schema registry: which raw columns mean what, and in which unit."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from string import Formatter

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Canonical names, the column names of the known naming schemes in the order of
# INTERNAL, the factors of the known current units, and the template that names a schema.
INTERNAL = ("time", "current", "density", "temperature", "vloop")
CANONICAL = (
    "time_s",
    "plasma_current_MA",
    "electron_density",
    "electron_temperature",
    "loop_voltage",
)
NAMING_SCHEMES = {
    "canonical": (
        "time_s", "plasma_current", "electron_density", "electron_temperature", "loop_voltage",
    ),
    "raw": ("t", "Ip", "ne", "Te", "Vl"),
    "verbose": (
        "timestamp_seconds", "Ip_plasma_MA", "ne_electron_1e19_m3", "Te_electron_keV", "V_loop_volts",
    ),
}
CURRENT_UNITS = {"MA": 1.0, "A": 1.0e-6}
SCHEMA_TEMPLATE = "{column_naming_scheme}_{current_unit}"

_ROW = (
    "schema_applied string, expected array<string>, "
    "columns array<array<struct<raw: string, factor: double>>>"
)


@dataclass(frozen=True)
class SourceRegistry:
    """Declarative description of the sources; a new source needs no code."""

    canonical_columns: Mapping[str, str]
    schemas: Mapping[str, Mapping]
    template: str

    @classmethod
    def default(cls) -> SourceRegistry:
        """Every known naming scheme combined with every known current unit."""
        return cls(
            dict(zip(INTERNAL, CANONICAL)),
            {
                f"{naming}_{unit}": {
                    "column_mapping": dict(zip(raw, INTERNAL)),
                    "unit_conversions": {"current": factor},
                    "expected_columns": list(raw),
                }
                for naming, raw in NAMING_SCHEMES.items()
                for unit, factor in CURRENT_UNITS.items()
            },
            SCHEMA_TEMPLATE,
        )

    @classmethod
    def from_text(cls, text: str) -> SourceRegistry:
        doc = yaml.safe_load(text)
        names = doc["canonical_columns"]
        names = {"time": names["time"], **names}  # time comes first
        return cls(names, doc["schemas"], doc["resolution"]["pattern"])

    @classmethod
    def from_yaml(cls, path: str) -> SourceRegistry:
        with open(path, encoding="utf-8") as f:
            return cls.from_text(f.read())

    @property
    def template_keys(self) -> list[str]:
        return [key for _, key, _, _ in Formatter().parse(self.template) if key]

    def resolve(self, metadata: Mapping) -> str:
        """Schema name for one metadata record."""
        missing = [k for k in self.template_keys if k not in metadata]
        if missing:
            raise ValueError(f"insufficient metadata to resolve the schema: {missing}")
        return self.template.format(**metadata)

    def schema_name(self, fields: Column) -> Column:
        """Schema name from a ``map<string,string>`` of metadata; NULL if a key has no value."""
        parts = []
        for text, key, _, _ in Formatter().parse(self.template):
            parts += [F.lit(text)] if text else []
            parts += [fields[key]] if key else []
        return F.concat(*parts)

    def columns_of(self, schema: Mapping) -> list[list[tuple[str, float]]]:
        """For each canonical column the raw names that can supply it, with their factors."""
        mapping = schema["column_mapping"]
        factors = schema.get("unit_conversions") or {}
        out = []
        for internal, canonical in self.canonical_columns.items():
            factor = float(factors.get(internal, 1.0))
            names = [raw for raw, to in mapping.items() if to == internal]
            names += [internal] if internal not in mapping else []
            direct = [] if canonical in mapping or canonical in names else [(canonical, 1.0)]
            out.append([(raw, factor) for raw in names] + direct)
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per schema. Its size is that of the registry file, so it is broadcast."""
        rows = [
            (name, list(schema["expected_columns"]), self.columns_of(schema))
            for name, schema in self.schemas.items()
        ]
        return F.broadcast(spark.createDataFrame(rows, _ROW))
