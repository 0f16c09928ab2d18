"""Table profiling, key discovery and relationships between tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebody.functions.expr import numeric_columns
from orebody.sources import io

HIGH_NULL = 0.5
ORPHANS = 0.01
#: Columns in one aggregate of distinct counts.
CHUNK = 16


def key_like(name: str) -> bool:
    """Default name rule of key candidates; every function takes another."""
    low = name.lower()
    return low.endswith("_id") or low.startswith("sk_") or low == "id" or "_id_" in low


def _counts(df: DataFrame, columns: list[str]):
    """One pass: (rows, {column: (present, distinct)})."""
    aggs = [F.count("*").alias("n")]
    for k, c in enumerate(columns):
        aggs += [F.count(F.col(f"`{c}`")).alias(f"c{k}"), F.count_distinct(F.col(f"`{c}`")).alias(f"d{k}")]
    row = df.agg(*aggs).first()
    return row["n"], {c: (row[f"c{k}"], row[f"d{k}"]) for k, c in enumerate(columns)}


def is_valid_primary_key(df: DataFrame, column: str) -> bool:
    n, found = _counts(df, [column])
    return found[column] == (n, n)


def detect_primary_key(df: DataFrame, rule=key_like) -> list[str]:
    """Key-like columns, in order, without nulls or repeats."""
    named = [c for c in df.columns if rule(c)]
    n, found = _counts(df, named)
    return [c for c in named if found[c] == (n, n)]


def primary_key_candidates(df: DataFrame, rule=key_like) -> DataFrame:
    """column, null_count, null_rate, unique_count, total_count, is_unique, is_valid_pk of key-like columns."""
    named = [c for c in df.columns if rule(c)]
    schema = "column string, null_count bigint, null_rate double, unique_count bigint, total_count bigint, is_unique boolean, is_valid_pk boolean"
    if not named:
        return df.sparkSession.createDataFrame([], schema)
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            (F.count("*") - F.count(F.col(f"`{c}`"))).alias("null_count"),
            F.count_distinct(F.col(f"`{c}`")).alias("unique_count"),
            F.count("*").alias("total_count"),
        )
        for c in named
    ]
    rows = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    return rows.select(
        "column",
        "null_count",
        F.coalesce(F.round(F.try_divide(F.col("null_count").cast("double"), F.col("total_count")), 4), F.lit(0.0)).alias("null_rate"),
        "unique_count",
        "total_count",
        (F.col("unique_count") == F.col("total_count")).alias("is_unique"),
        ((F.col("unique_count") == F.col("total_count")) & (F.col("null_count") == 0)).alias("is_valid_pk"),
    )


def orphan_rate(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """child_values, orphan_values and orphan_rate of a foreign key, over distinct values; 0 for an empty child."""
    values = child.select(F.col(f"`{key}`").alias("k")).filter("k IS NOT NULL").distinct()
    known = parent.select(F.col(f"`{parent_key or key}`").alias("k"), F.lit(True).alias("known")).distinct()
    return values.join(known, "k", "left").agg(
        F.count("*").alias("child_values"),
        F.count_if(F.col("known").isNull()).alias("orphan_values"),
        F.coalesce(F.try_divide(F.count_if(F.col("known").isNull()).cast("double"), F.count("*")), F.lit(0.0)).alias("orphan_rate"),
    )


def detect_foreign_keys(child: DataFrame, parent: DataFrame, parent_key: str, most_orphans: float = ORPHANS) -> list[str]:
    """The parent's key, if the child has a column of that name with fewer than ``most_orphans`` orphans."""
    if parent_key not in child.columns:
        return []
    return [parent_key] if orphan_rate(child, parent, parent_key).first()["orphan_rate"] < most_orphans else []


RELATIONSHIPS = (
    "parent_table string, parent_pk string, child_table string, foreign_key string, parent_count bigint, "
    "child_count bigint, matched_child_count bigint, relationship_type string"
)


def relationship(parent_table: str, parent: DataFrame, child_table: str, child: DataFrame, key: str) -> DataFrame:
    """The one-row record of a pair: counts of both, of the children with a parent, and the kind."""
    one = lambda df, name: df.agg(F.count("*").alias(name)).withColumn("__one", F.lit(1))
    matched = child.join(parent.select(key).distinct(), key, "left_semi")
    counts = one(parent, "parent_count").join(one(child, "child_count"), "__one").join(one(matched, "matched_child_count"), "__one")
    return counts.select(
        F.lit(parent_table).alias("parent_table"),
        F.lit(key).alias("parent_pk"),
        F.lit(child_table).alias("child_table"),
        F.lit(key).alias("foreign_key"),
        "parent_count",
        "child_count",
        "matched_child_count",
        F.when(F.col("matched_child_count") > F.col("parent_count"), "one_to_many").otherwise("one_to_one").alias("relationship_type"),
    )


def relationships(tables: dict[str, DataFrame], rule=key_like) -> DataFrame:
    """Records of all ordered pairs of tables in which the parent's first key is a foreign key of the child."""
    keys = {name: (detect_primary_key(df, rule) or [None])[0] for name, df in tables.items()}
    out = next(iter(tables.values())).sparkSession.createDataFrame([], RELATIONSHIPS)
    for p, parent in tables.items():
        for c, child in tables.items():
            if p != c and keys[p] and detect_foreign_keys(child, parent, keys[p]):
                out = out.unionByName(relationship(p, parent, c, child, keys[p]))
    return out


def first_values(df: DataFrame, column: str, n: int = 3) -> list[str]:
    """The first present values of a column, as text, in the order of the table's partitions; reads no further than it must."""
    x = F.col(f"`{column}`")
    return [r[0] for r in df.select(x.cast("string")).filter(x.isNotNull()).limit(n).collect()]


def column_quality(df: DataFrame) -> DataFrame:
    """dtype, nulls, distinct values, the first three present values and, of numeric columns, min, max and mean.

    Counting distinct values of several columns at once sends each row once a column, so wide tables are cut.
    """
    numeric = set(numeric_columns(df))
    out = None
    for i in range(0, len(df.columns), CHUNK):
        cells = []
        for c, kind in df.dtypes[i : i + CHUNK]:
            x = F.col(f"`{c}`")
            number = x.cast("double") if c in numeric and kind != "boolean" else F.lit(None).cast("double")
            cells.append(
                F.struct(
                    F.lit(c).alias("column"),
                    F.lit(kind).alias("dtype"),
                    (F.count("*") - F.count(x)).alias("null_count"),
                    F.count("*").alias("__n"),
                    F.count_distinct(x).alias("unique_count"),
                    F.array(*[F.lit(v) for v in first_values(df, c)]).cast("array<string>").alias("sample_values"),
                    F.min(number).alias("min"),
                    F.max(number).alias("max"),
                    F.avg(number).alias("mean"),
                )
            )
        part = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
        out = part if out is None else out.unionByName(part)
    share = lambda c: F.coalesce(F.round(F.try_divide(F.col(c).cast("double"), F.col("__n")), 4), F.lit(0.0))
    return out.select("column", "dtype", "null_count", share("null_count").alias("null_rate"), "unique_count", share("unique_count").alias("unique_rate"), "sample_values", "min", "max", "mean")


def table_summary(df: DataFrame, rule=key_like) -> dict:
    quality = column_quality(df).collect()  # one row a column
    stats = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return {
        "row_count": df.count(),
        "column_count": len(df.columns),
        "memory_mb": round(int(str(stats)) / 2**20, 2),
        "primary_key_candidates": [r.asDict() for r in primary_key_candidates(df, rule).collect()],
        "valid_primary_keys": detect_primary_key(df, rule),
        "high_null_columns": [r["column"] for r in quality if r["null_rate"] > HIGH_NULL],
        "constant_columns": [r["column"] for r in quality if r["unique_count"] <= 1],
        "columns": [r.asDict() for r in quality],
    }


def main_table(records: DataFrame) -> str | None:
    """The table with most child relationships, the first by name of equals."""
    row = records.groupBy("parent_table").count().orderBy(F.desc("count"), "parent_table").first()
    return row["parent_table"] if row else None


def explore(spark: SparkSession, folder: str, output: str | None = None, sample_size: int | None = None, most: int = 15) -> dict:
    """Profiles every table of a folder and their relationships; writes a JSON report and a guide if asked."""
    tables, failed = {}, {}
    for name, path in io.list_tables(folder, most):
        try:
            df = io.read(spark, path)
            tables[name] = df.limit(sample_size) if sample_size else df
        except Exception as e:  # noqa: BLE001  a broken file is reported, the others go on
            failed[name] = str(e).splitlines()[0]
    if not tables:
        return {"error": f"no CSV or Parquet files in {folder}", "failed": failed}
    records = relationships(tables)
    report = {
        "tables": {n: table_summary(df) for n, df in tables.items()},
        "relationships": [r.asDict() for r in records.collect()],
        "main_table": main_table(records),
        "failed": failed,
    }
    if output:
        io.write_json(report, os.path.join(output, "exploration_report.json"))
        io.write_text(relationship_guide(report), os.path.join(output, "relationship_guide.md"))
    return report


def relationship_guide(report: dict) -> str:
    """Markdown: tables, relationships and entity configurations to start from."""
    lines = ["# Relationships", "", f"Main table: {report['main_table'] or 'none found'}", "", "| parent | key | child | kind | matched |", "| --- | --- | --- | --- | --- |"]
    lines += [f"| {r['parent_table']} | {r['parent_pk']} | {r['child_table']} | {r['relationship_type']} | {r['matched_child_count']} |" for r in report["relationships"]]
    lines += ["", "## Entities", "", "```python"]
    parents = {r["child_table"]: r for r in report["relationships"]}
    for name, t in report["tables"].items():
        key = (t["valid_primary_keys"] or [f"{name}_id"])[0]
        link = f", parent={parents[name]['parent_table']!r}, foreign_key={parents[name]['foreign_key']!r}" if name in parents else ""
        lines.append(f"EntityConfig(name={name!r}, file_path='{name}.parquet', index={key!r}{link})")
    return "\n".join([*lines, "```", ""])


def console_report(report: dict) -> str:
    lines = []
    for name, t in report.get("tables", {}).items():
        lines.append(f"{name}: {t['row_count']} rows, {t['column_count']} columns, keys {', '.join(t['valid_primary_keys']) or 'none'}")
        if t["high_null_columns"]:
            lines.append(f"  mostly null: {', '.join(t['high_null_columns'][:3])}")
    lines += [f"{r['parent_table']}.{r['parent_pk']} <- {r['child_table']} ({r['relationship_type']})" for r in report.get("relationships", [])[:10]]
    return "\n".join(lines)
