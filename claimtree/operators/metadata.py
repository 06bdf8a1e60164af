"""Settings that drive the hierarchy: column metadata, configuration, images."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from claimtree.operators.scale import ranked
from claimtree.sources.tables import bounded_rows, resolve_column

SETTINGS_ROWS = 10_000

# Headers of the settings tables and the words that mean "no filter".
META_HEADERS = ["Name", "Level", "Key", "Text", "Type", "Format", "Category"]
CONFIG_HEADERS = ["Section", "Subsection", "Attribute", "Value", "Parameter", "Content"]
IMAGE_HEADERS = ["View", "Value", "Path"]
NO_FILTER_WORDS = ["all", "none", ""]


@dataclass(frozen=True)
class LevelColumn:
    name: str
    level: int
    key: str
    text: str
    dtype: str
    format: str = "%s"
    category: str = "-"


@dataclass(frozen=True)
class HierarchyMeta:
    """Which wide-table column holds which attribute of which level."""

    columns: tuple[LevelColumn, ...]
    id_key: str = "EntityId"
    name_key: str = "EntityName"
    relation_key: str = "RelationType"
    primary_key: str = "PrimaryFlag"
    shorten: tuple[str, ...] = field(default=())

    @property
    def max_depth(self) -> int:
        return max(c.level for c in self.columns)

    @property
    def has_primary(self) -> bool:
        return any(c.key == self.primary_key for c in self.columns)

    def column(self, level: int, key: str) -> LevelColumn | None:
        return next((c for c in self.columns if c.level == level and c.key == key), None)

    def keys(self) -> list[str]:
        return list(dict.fromkeys(c.key for c in self.columns))

    def attribute(self, key: str) -> LevelColumn:
        """Display settings of a key; the last row of the metadata table wins."""
        return [c for c in self.columns if c.key == key][-1]

    def categories(self) -> dict[str, list[str]]:
        found: dict[str, list[str]] = {}
        for c in self.columns:
            if c.category != "-":
                keys = found.setdefault(c.category, [])
                if c.key not in keys:
                    keys.append(c.key)
        return found


def settings_rows(df: DataFrame, headers: Sequence[str], order: str | None, what: str) -> list:
    """A settings table on the driver, in the order of a column where one is named."""
    rows = df.orderBy(order) if order else df
    return bounded_rows(rows.select(*[resolve_column(df, h) for h in headers]), SETTINGS_ROWS, what)


def load_meta(columns: DataFrame, config: dict | None = None, order: str | None = None) -> HierarchyMeta:
    """Read the column metadata table (and the names of the special columns from the configuration)."""
    rows = settings_rows(columns, META_HEADERS, order, "the columns table")
    parsed = tuple(
        LevelColumn(str(r[0]), int(r[1]), str(r[2]), str(r[3]), str(r[4]), str(r[5]), str(r[6])) for r in rows
    )
    data = (config or {}).get("data", {})
    names = {k: v["value"] for k, v in data.get("column_name", {}).items()}
    short = data.get("format_value", {}).get("short_value", {}).get("value", "")
    return HierarchyMeta(
        parsed,
        id_key=names.get("entity_id", "EntityId"),
        name_key=names.get("entity_name", "EntityName"),
        relation_key=names.get("relation_type", "RelationType"),
        shorten=tuple(s.strip() for s in short.split("|") if s.strip()),
    )


def load_config(config: DataFrame, order: str | None = None) -> dict:
    """Nested settings: section, subsection (absent when ``-``), attribute; later rows win."""
    found: dict = {}
    rows = settings_rows(config, CONFIG_HEADERS, order, "the config table")
    for section, subsection, attribute, value, parameters, content in rows:
        home = found.setdefault(section, {})
        if subsection != "-":
            home = home.setdefault(subsection, {})
        home[attribute] = {"value": value, "parameters": parameters, "content": content}
    return found


def config_pivot(config: DataFrame, order: str) -> DataFrame:
    """Last value per section, subsection and attribute, as rows; ``-`` becomes a NULL subsection."""
    subsection = F.when(F.col("Subsection") != "-", F.col("Subsection"))
    last = F.max(F.struct(order, "Value", "Parameter", "Content"))
    rows = config.groupBy("Section", subsection.alias("subsection"), "Attribute").agg(last.alias("_last"))
    return rows.select(
        F.col("Section").alias("section"), "subsection", F.col("Attribute").alias("attribute"),
        F.col("_last.Value").alias("value"), F.col("_last.Parameter").alias("parameters"),
        F.col("_last.Content").alias("content"),
    )


def meta_categories(columns: DataFrame, order: str) -> DataFrame:
    """Distinct keys of each category in order of first appearance, one row per key."""
    rows = columns.where(F.col("Category") != "-").groupBy("Category", "Key").agg(F.min(order).alias("_first"))
    placed = ranked(rows, ["Category"], [F.col("_first"), F.col("Key")])
    return placed.select(F.col("Category").alias("category"), F.col("Key").alias("key"), "position")


def max_depth(columns: DataFrame) -> DataFrame:
    return columns.agg(F.max(F.col("Level").cast("int")).alias("max_depth"))


def filter_values(value: str | Sequence[str] | None) -> list[str] | None:
    """The values of a filter, or None for no filter (missing, empty, or the word all / none)."""
    if value is None:
        return None
    values = [value] if isinstance(value, str) else list(value)
    if not values or (len(values) == 1 and values[0].lower() in NO_FILTER_WORDS):
        return None
    return values


def _sort_settings(config: dict, params: dict[str, str]) -> list[tuple[str, str]]:
    """(parameter's value, setting's value) of every sort setting, in order."""
    settings = config.get("filters", {}).get("func_sort", {})
    for name in settings:
        if name not in params:
            raise ValueError(f"Cannot find filter {name}: please check the filter name in the config")
    return [(params[name], setting["value"]) for name, setting in settings.items()]


def resolve_sort(config: dict, params: dict[str, str]) -> str | None:
    """The column to sort by: a fixed name, or the parameter's value where the setting is ``{...}``.

    The last setting whose parameter is not ``none`` counts; a later ``none`` leaves its order in place.
    """
    columns = [chosen if "{" in value else value for chosen, value in _sort_settings(config, params) if chosen.lower() != "none"]
    return columns[-1] if columns else None


def resolve_metric(config: dict, params: dict[str, str]) -> str | None:
    """The metric that cards show: the last sort parameter's value, whatever column it sorts by; None for ``none``."""
    chosen = [value for value, _ in _sort_settings(config, params)]
    return chosen[-1] if chosen and chosen[-1].lower() != "none" else None
