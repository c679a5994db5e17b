"""Column resolution and projection."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions.ledger import quoted
from tiffin.schemas import CATEGORY_FEATURES, COLUMN_SPELLINGS, CONTEXT_NAMES, OPTIONAL_DEFAULTS

__all__ = [
    "canonical_columns", "context_alias", "ensure_or_default", "normalise_names",
    "project_features", "quoted", "require_columns", "resolve_columns",
]


def resolve_columns(df: DataFrame, spellings: dict[str, list[str]]) -> dict[str, str | None]:
    """For each wanted column the actual name in `df`, letter case aside, or None."""
    actual = {name.lower(): name for name in df.columns}
    return {
        wanted: next((actual[s.lower()] for s in accepted if s.lower() in actual), None)
        for wanted, accepted in spellings.items()
    }


def ensure_or_default(df: DataFrame, name: str, accepted: list[str], default) -> DataFrame:
    """Give `df` the column `name`: one of the accepted spellings, else a constant."""
    found = resolve_columns(df, {name: accepted})[name]
    if found is None:
        return df.withColumn(name, F.lit(default))
    return df.withColumnRenamed(found, name)


def require_columns(df: DataFrame, spellings: dict[str, list[str]]) -> dict[str, str]:
    """Resolve all wanted columns, or fail before any job runs and name what is missing."""
    found = resolve_columns(df, spellings)
    missing = [" / ".join(spellings[wanted]) for wanted, name in found.items() if name is None]
    if missing:
        raise ValueError(
            f"missing required columns: {missing}; available columns: {', '.join(df.columns)}"
        )
    return found


def canonical_columns(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One projection that brings an orders table to its canonical column names."""
    required = {w: s for w, s in COLUMN_SPELLINGS.items() if w not in OPTIONAL_DEFAULTS}
    found = require_columns(df, required)
    optional = resolve_columns(df, {w: COLUMN_SPELLINGS[w] for w in OPTIONAL_DEFAULTS})
    columns = [F.col(quoted(name)).alias(wanted) for wanted, name in found.items()]
    for wanted, name in optional.items():
        source = F.col(quoted(name)) if name else F.lit(OPTIONAL_DEFAULTS[wanted])
        columns.append(source.alias(wanted))
    return df.select(*[F.col(quoted(k)) for k in keep or []], *columns)


def normalise_names(df: DataFrame) -> DataFrame:
    """Trimmed, lower-case names with underscores; repeats are numbered `_1`, `_2`."""
    seen: Counter[str] = Counter()
    names = []
    for name in (c.strip().lower().replace(" ", "_") for c in df.columns):
        names.append(f"{name}_{seen[name]}" if seen[name] else name)
        seen[name] += 1
    return df.toDF(*names)


def project_features(
    df: DataFrame, numeric: list[str], context: list[str], categories: list[str] | None = None
) -> DataFrame:
    """Model inputs then context, each column once and in first-named order."""
    names = dict.fromkeys([*context, *numeric, *(categories or CATEGORY_FEATURES)])
    return df.select(*[F.col(quoted(name)) for name in names])


def context_alias(df: DataFrame, also: list[str] | None = None) -> DataFrame:
    """The request columns that travel to the response, under their context names."""
    return df.select(
        *(also or ["UUID"]),
        *[F.col(name).alias(alias) for name, alias in CONTEXT_NAMES.items()],
    )
