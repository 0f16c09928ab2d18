"""Composite features: formulas compiled from a whitelisted syntax tree to columns, and fixed forms of crossing."""

from __future__ import annotations

import ast
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebody.functions.expr import clip, coalesce0, nullif0
from orebody.sources import io

SPEC_COLUMNS = "feature_name string, formula string, base_features string, business_definition string, risk_direction string, notes string"


@dataclass(frozen=True)
class CompositeSpec:
    feature_name: str
    formula: str
    base_features: tuple[str, ...] = ()
    business_definition: str = ""
    risk_direction: str = ""
    notes: str = ""

    def row(self) -> tuple:
        return (self.feature_name, self.formula, ",".join(self.base_features), self.business_definition, self.risk_direction, self.notes)

    def to_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([self.row()], SPEC_COLUMNS)


class FormulaError(ValueError):
    pass


_CALLS = {
    "fillna": lambda x, v: F.coalesce(x, v),
    "abs": F.abs,
    "log": lambda x: F.when(x > 0, F.log(x)),
    "log1p": lambda x: F.when(x > -1, F.log1p(x)),
    "sqrt": lambda x: F.when(x >= 0, F.sqrt(x)),
    "exp": F.exp,
    "where": lambda c, a, b: F.when(F.coalesce(c, F.lit(False)), a).otherwise(b),
    "minimum": lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.least(a, b)),
    "maximum": lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b)),
    "clip": lambda x, a, b: F.when(x.isNotNull(), F.least(F.greatest(x, a), b)),
    "isnan": lambda x: x.isNull(),
}
_ARITHMETIC = {
    ast.Add: lambda a, b: a + b,
    ast.Sub: lambda a, b: a - b,
    ast.Mult: lambda a, b: a * b,
    ast.Div: lambda a, b: a.cast("double") / nullif0(b.cast("double")),
    ast.Pow: lambda a, b: F.pow(a, b),
    ast.BitAnd: lambda a, b: a & b,
    ast.BitOr: lambda a, b: a | b,
}
_COMPARE = {ast.Lt: "__lt__", ast.LtE: "__le__", ast.Gt: "__gt__", ast.GtE: "__ge__", ast.Eq: "__eq__", ast.NotEq: "__ne__"}


def compile_formula(formula: str, columns: list[str]) -> Column:
    """A column for a formula over ``columns``; FormulaError for names, calls or syntax that are not allowed."""

    def go(node) -> Column:
        if isinstance(node, ast.Expression):
            return go(node.body)
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float, bool, str)):
            return F.lit(float(node.value)) if isinstance(node.value, float) else F.lit(node.value)
        if isinstance(node, ast.Name):
            if node.id not in columns:
                raise FormulaError(f"no column {node.id}")
            return F.col(f"`{node.id}`")
        if isinstance(node, ast.BinOp) and type(node.op) in _ARITHMETIC:
            return _ARITHMETIC[type(node.op)](go(node.left), go(node.right))
        if isinstance(node, ast.UnaryOp):
            x = go(node.operand)
            if isinstance(node.op, ast.USub):
                return -x
            if isinstance(node.op, ast.UAdd):
                return x
            return ~x
        if isinstance(node, ast.Compare) and len(node.ops) == 1 and type(node.ops[0]) in _COMPARE:
            return getattr(go(node.left), _COMPARE[type(node.ops[0])])(go(node.comparators[0]))
        if isinstance(node, ast.Attribute) and isinstance(node.value, ast.Name) and node.value.id == "np" and node.attr == "nan":
            return F.lit(None).cast("double")
        if isinstance(node, ast.Call) and not node.keywords:
            if isinstance(node.func, ast.Name) and node.func.id in ("fillna", "abs"):
                return _CALLS[node.func.id](*map(go, node.args))
            if isinstance(node.func, ast.Attribute) and isinstance(node.func.value, ast.Name) and node.func.value.id == "np" and node.func.attr in _CALLS:
                return _CALLS[node.func.attr](*map(go, node.args))
            if isinstance(node.func, ast.Attribute) and node.func.attr in ("fillna", "abs", "clip"):
                return _CALLS[node.func.attr](go(node.func.value), *map(go, node.args))
        raise FormulaError(f"not allowed: {ast.unparse(node)}")

    try:
        return go(ast.parse(formula, mode="eval"))
    except SyntaxError as e:
        raise FormulaError(str(e)) from e


@dataclass(frozen=True)
class CompositeFeatures:
    matrix: DataFrame
    valid: list[CompositeSpec]
    rejected: list[tuple[str, str]]


def build_composites(df: DataFrame, specs: list[CompositeSpec], output: str | None = None) -> CompositeFeatures:
    """Adds the specs in order (later ones may use earlier ones); those that fail are listed with the reason."""
    valid, rejected = [], []
    for s in specs:
        try:
            missing = [c for c in s.base_features if c not in df.columns]
            if missing:
                raise FormulaError(f"no column {', '.join(missing)}")
            made = df.withColumn(s.feature_name, compile_formula(s.formula, df.columns))
            made.schema  # noqa: B018  analysis errors show here
            df, valid = made, [*valid, s]
        except Exception as e:  # noqa: BLE001  any failure rejects this spec only
            rejected.append((s.feature_name, str(e).splitlines()[0]))
    if output:
        io.write_matrix(df, f"{output}/composite_feature_matrix.parquet")
        io.write_report(specs_frame(df.sparkSession, valid), f"{output}/composite_feature_specs.csv")
    return CompositeFeatures(df, valid, rejected)


def specs_frame(spark, specs: list[CompositeSpec]) -> DataFrame:
    """One row a spec."""
    return spark.createDataFrame([s.row() for s in specs], SPEC_COLUMNS)


def example_specs() -> list[CompositeSpec]:
    """A ratio, a guarded quotient, an interaction and a rule, over the credit schema."""
    return [
        CompositeSpec(
            "composite_credit_usage_ratio",
            "np.where(fillna(AMT_CREDIT_LIMIT_ACTUAL, 0) != 0, fillna(AMT_BALANCE, 0) / fillna(AMT_CREDIT_LIMIT_ACTUAL, 0), np.nan)",
            ("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"),
            "share of the card's limit in use",
            "higher_is_riskier",
        ),
        CompositeSpec(
            "composite_income_to_annuity_ratio",
            "np.where(fillna(AMT_ANNUITY, 0) == 0, np.nan, fillna(AMT_INCOME_TOTAL, 0) / fillna(AMT_ANNUITY, 0))",
            ("AMT_INCOME_TOTAL", "AMT_ANNUITY"),
            "how often the income covers a year's payments",
            "lower_is_riskier",
            "under 2 is strained",
        ),
        CompositeSpec(
            "composite_velocity_x_external",
            "fillna(prev_app_count_30d, 0) * (1 - fillna(EXT_SOURCE_2, 0))",
            ("prev_app_count_30d", "EXT_SOURCE_2"),
            "recent applications weighed by the external score",
            "higher_is_riskier",
        ),
        CompositeSpec(
            "composite_high_risk_flag",
            "np.where((fillna(prev_reject_count, 0) > 0) & (fillna(EXT_SOURCE_1, 0) < 0.3), 1, 0)",
            ("prev_reject_count", "EXT_SOURCE_1"),
            "refused before and a low external score",
            "higher_is_riskier",
        ),
    ]


def cross(a: str, b: str, operator: str = "*") -> Column:
    """Nulls count as 0; a zero divisor gives null; an unknown operator multiplies."""
    x, y = (coalesce0(F.col(f"`{c}`").cast("double")) for c in (a, b))
    if operator == "/":
        return x / nullif0(y)
    return {"+": x + y, "-": x - y}.get(operator, x * y)


def flag(condition: str, columns: list[str]) -> Column:
    """1 where the condition holds, else 0 (null comparisons too)."""
    return F.coalesce(compile_formula(condition, columns), F.lit(False)).cast("int")


def ratio_feature(a: str, b: str) -> Column:
    """a / b, and 0 where that is null."""
    return coalesce0(F.col(f"`{a}`").cast("double") / nullif0(F.col(f"`{b}`").cast("double")))


def interaction(a: str, b: str, operation: str = "multiply") -> Column:
    x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
    kinds = {"multiply": x * y, "add": x + y, "subtract": x - y}
    if operation not in kinds:
        raise ValueError(f"unknown operation {operation}")
    return kinds[operation]


def velocity_risk(df: DataFrame, count: str = "velocity_prev_count_7d", external: str = "EXT_SOURCE_2", rejects: str = "prev_reject_rate") -> DataFrame:
    if {count, external} <= set(df.columns):
        df = df.withColumn("composite_velocity_external", F.col(count) * (1 - F.col(external)))
    if {rejects, external} <= set(df.columns):
        df = df.withColumn("composite_reject_low_score_flag", F.coalesce((F.col(rejects) > 0.5) & (F.col(external) < 0.3), F.lit(False)).cast("int"))
    return df


def stability_risk(df: DataFrame, employed: str = "DAYS_EMPLOYED", credit: str = "AMT_CREDIT", income: str = "AMT_INCOME_TOTAL") -> DataFrame:
    """(1 - years employed, clipped to 0..1) * credit / income; absent columns count as 1."""
    col = lambda c: F.col(c).cast("double") if c in df.columns else F.lit(1.0)
    return df.withColumn("composite_stability_risk", (1 - clip(-col(employed) / 365, 0.0, 1.0)) * col(credit) / nullif0(col(income)))
