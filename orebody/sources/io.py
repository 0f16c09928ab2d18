"""Scans with NaN read as null and configured columns pruned, and the sinks of matrices and reports."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def clean(df: DataFrame) -> DataFrame:
    """NaN becomes null, once, on the way in."""
    floats = [c for c, t in df.dtypes if t in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats}) if floats else df


def read(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet by its suffix, anything else as CSV with a header; of ``columns``, those that exist."""
    if str(path).endswith(".parquet"):
        df = spark.read.parquet(str(path))
    else:
        df = spark.read.csv(str(path), header=True, inferSchema=True, nullValue="", nanValue="NaN")
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])
    return clean(df)


def write_matrix(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(str(path))


def write_report(df: DataFrame, path: str) -> None:
    """A small frame (one row a feature) as one CSV part."""
    df.coalesce(1).write.mode("overwrite").csv(str(path), header=True)


def write_json(document: dict, path: str) -> None:
    """Driver-side document, written to a new file that then takes the old one's place."""
    os.makedirs(os.path.dirname(str(path)) or ".", exist_ok=True)
    draft = f"{path}.{os.getpid()}.new"
    with open(draft, "w", encoding="utf-8") as f:
        json.dump(document, f, ensure_ascii=False, indent=2, default=str)
    os.replace(draft, str(path))


def write_text(text: str, path: str) -> None:
    os.makedirs(os.path.dirname(str(path)) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def list_tables(folder: str, most: int = 15) -> list[tuple[str, str]]:
    """(name, path) of the folder's CSV and then Parquet files, in order of name, at most ``most``."""
    names = sorted(os.listdir(folder))
    found = [x for x in names if x.endswith(".csv")] + [x for x in names if x.endswith(".parquet")]
    return [(os.path.splitext(x)[0], os.path.join(folder, x)) for x in found[:most]]
