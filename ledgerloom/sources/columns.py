"""Column names, presence and order. Works on the schema only; no job is run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters of a heading and what they become.
HEADING_FOLDS = {"ë": "e", "Ë": "E", "ç": "c", "Ç": "C"}
HEADING_QUOTES = "'’‘\""
HEADING_BREAKS = "()[]/-:,."
HEADING_WORDS = {"%": " perqind ", "&": " dhe "}


def normalize_name(name: str) -> str:
    """Heading to snake case; ``%`` and ``&`` become words, other marks vanish."""
    table = {ord(k): v for k, v in {**HEADING_FOLDS, **HEADING_WORDS}.items()}
    table.update({ord(q): None for q in HEADING_QUOTES})
    table.update({ord(b): " " for b in HEADING_BREAKS})
    words = str(name).strip().translate(table).split()
    kept = re.sub(r"[^A-Za-z0-9_]", "", "_".join(words))
    return re.sub(r"_+", "_", kept).strip("_").lower()


def normalize_columns(df: DataFrame) -> DataFrame:
    """All headings normalised; two headings that meet are an error."""
    names = [normalize_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"headings collide after normalising: {clashes}")
    return df.toDF(*names)


def require_columns(df: DataFrame, columns) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    return df


def add_missing(df: DataFrame, columns: dict[str, str], fill=None) -> DataFrame:
    """Add absent columns ``{name: type}`` holding ``fill``."""
    return df.withColumns({c: F.lit(fill).cast(kind) for c, kind in columns.items() if c not in df.columns})


def ordered(df: DataFrame, columns) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])


def drop_present(df: DataFrame, columns) -> tuple[DataFrame, list[str]]:
    """Drop those of the columns that exist; also tell which."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*present), present


def pick_features(df: DataFrame, groups, leaking=(), dropped=()) -> list[str]:
    """Feature names in group order: present, not leaking, not dropped, once each."""
    barred = {*leaking, *dropped}
    names = list(dict.fromkeys(c for group in groups for c in group if c in df.columns and c not in barred))
    if not names:
        raise ValueError("no feature column is present")
    return names


def prune_features(features, importance: DataFrame, threshold: float = 0.0) -> list[str]:
    """Features whose importance exceeds the threshold; unknown ones are kept."""
    weak = {r["feature"] for r in importance.filter(F.col("importance") <= threshold).select("feature").collect()}
    return [f for f in features if f not in weak]


def split_by_kind(df: DataFrame, columns) -> tuple[list[str], list[str]]:
    """(categorical, numeric) by declared type: text and booleans are categorical."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    categorical = [c for c in columns if isinstance(kinds[c], (T.StringType, T.BooleanType))]
    return categorical, [c for c in columns if c not in categorical]


def type_features(df: DataFrame, categorical, numeric, missing: str = "__missing__", numeric_fill=None) -> DataFrame:
    """Categorical to text with a missing word, numeric to double with an optional fill."""
    typed = {c: F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in categorical}
    for c in numeric:
        value = F.col(c).try_cast("double")
        typed[c] = value if numeric_fill is None else F.coalesce(value, F.lit(float(numeric_fill)))
    return df.withColumns(typed)
