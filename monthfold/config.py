"""Run configuration: a frozen dataclass and a YAML loader for it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from decimal import Decimal
from typing import Any

from monthfold.operators.validate import PROFILES, Profile
from monthfold.schema import IDENTIFIER_COLUMNS, SALES_COLUMN_PATTERN


class ConfigError(ValueError):
    """The configuration is incomplete or contradicts itself."""


@dataclass(frozen=True)
class IngestConfig:
    """Everything one ingest run needs to know. Paths have no defaults."""

    source: str
    staging: str
    curated: str
    checkpoints: str
    logs: str
    file_pattern: str = "sales_*.csv"
    output_format: str = "parquet"
    partition_by: tuple[str, ...] = ("year", "month")
    identifier_columns: tuple[str, ...] = IDENTIFIER_COLUMNS
    sales_column_pattern: str = SALES_COLUMN_PATTERN
    profile: str = "strict_ids"
    enable_validation: bool = True
    enable_incremental: bool = True
    enable_schema_registry: bool = True
    enable_deduplication: bool = True
    reject_negative_sales: bool = True
    max_sales_value: Decimal = Decimal(1_000_000_000)
    dedup_scope: str = "file"
    refresh: str = "full"
    keep_summaries: bool = False
    spark_options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for name in ("source", "staging", "curated", "checkpoints", "logs"):
            if not getattr(self, name):
                raise ConfigError(f"path '{name}' is not set")
        if self.profile not in PROFILES:
            raise ConfigError(f"unknown profile '{self.profile}', expected one of {sorted(PROFILES)}")
        if self.dedup_scope not in ("file", "global"):
            raise ConfigError("dedup_scope is 'file' or 'global'")
        if self.refresh not in ("full", "touched_partitions"):
            raise ConfigError("refresh is 'full' or 'touched_partitions'")

    def rules(self) -> Profile:
        """The named profile with this configuration's switches applied.

        Switches only narrow a profile to what it supports: a profile without an
        upper bound stays without one, and one that keeps negatives keeps them.
        """
        base = PROFILES[self.profile]
        required = base.required
        if base.requires_all_identifiers:
            required = self.identifier_columns
        return replace(
            base,
            enabled=self.enable_validation,
            required=required,
            reject_negative=base.reject_negative and self.reject_negative_sales,
            max_amount=None if base.max_amount is None else Decimal(str(self.max_sales_value)),
            dedup=base.dedup and self.enable_deduplication,
        )


# Where each YAML entry lands in IngestConfig.
_YAML_FIELDS = {
    ("paths", "source"): "source",
    ("paths", "staging"): "staging",
    ("paths", "curated"): "curated",
    ("paths", "checkpoints"): "checkpoints",
    ("paths", "logs"): "logs",
    ("schema", "sales_column_pattern"): "sales_column_pattern",
    ("schema", "identifier_columns"): "identifier_columns",
    ("processing", "file_pattern"): "file_pattern",
    ("processing", "output_format"): "output_format",
    ("processing", "partition_by"): "partition_by",
    ("processing", "profile"): "profile",
    ("processing", "dedup_scope"): "dedup_scope",
    ("processing", "refresh"): "refresh",
    ("processing", "keep_summaries"): "keep_summaries",
    ("features", "enable_incremental"): "enable_incremental",
    ("features", "enable_schema_registry"): "enable_schema_registry",
    ("features", "enable_deduplication"): "enable_deduplication",
    ("features", "enable_validation"): "enable_validation",
    ("validation", "reject_negative_sales"): "reject_negative_sales",
    ("validation", "max_sales_value"): "max_sales_value",
    ("spark", "config"): "spark_options",
}
# Descriptive entries that change nothing about a run.
_YAML_IGNORED = {("pipeline", "name"), ("pipeline", "version"), ("spark", "app_name")}


def from_mapping(settings: Mapping[str, Mapping[str, Any]]) -> IngestConfig:
    """Build a configuration from nested sections, refusing entries it does not know."""
    values: dict[str, Any] = {}
    for section, entries in settings.items():
        for key, value in (entries or {}).items():
            if (section, key) in _YAML_IGNORED:
                continue
            target = _YAML_FIELDS.get((section, key))
            if target is None:
                raise ConfigError(f"unknown setting {section}.{key}")
            values[target] = tuple(value) if isinstance(value, list) else value
    missing = {"source", "staging", "curated", "checkpoints", "logs"} - values.keys()
    if missing:
        raise ConfigError(f"paths not set: {', '.join(sorted(missing))}")
    if "max_sales_value" in values:
        values["max_sales_value"] = Decimal(str(values["max_sales_value"]))
    return IngestConfig(**values)


def load_config(path: str) -> IngestConfig:
    """Read a YAML configuration file."""
    try:
        import yaml
    except ImportError as missing:
        raise ConfigError("reading YAML needs the pyyaml package; use from_mapping instead") from missing
    with open(path, encoding="utf-8") as handle:
        return from_mapping(yaml.safe_load(handle) or {})
