"""Business themes: plugins that turn source tables into features a key, attached to the anchor by left joins."""

from __future__ import annotations

from abc import ABC, abstractmethod
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orebody.functions.expr import count_if, nullif0, ratio, true_int

#: Table names that stand for each other.
ALIASES = {
    "application": ("application", "application_train", "applications"),
    "previous_application": ("previous_application", "previous_applications"),
    "bureau": ("bureau",),
    "credit_card_balance": ("credit_card_balance",),
    "installments_payments": ("installments_payments",),
}
ID_COLUMNS = ("SK_ID_CURR", "entity_id", "id", "ID", "customer_id", "user_id")
CURR, PREV = "SK_ID_CURR", "SK_ID_PREV"


def frame_of(frames: dict[str, DataFrame], name: str) -> DataFrame | None:
    return next((frames[a] for a in ALIASES.get(name, (name,)) if a in frames), None)


@dataclass(frozen=True)
class FeatureSpec:
    name: str
    theme: str
    hypothesis: str
    expected_direction: str
    calculation_logic: str
    source_tables: tuple[str, ...]
    status: str = "implemented"


class Theme(ABC):
    """``build`` returns the key and the theme's features, one row a key that has source rows."""

    name: str
    description: str

    @property
    @abstractmethod
    def specs(self) -> list[FeatureSpec]: ...

    @abstractmethod
    def build(self, frames: dict[str, DataFrame], anchor: DataFrame) -> DataFrame: ...

    def available(self, frames: dict[str, DataFrame]) -> bool:
        return all(frame_of(frames, t) is not None for s in self.specs for t in s.source_tables)


def registry_frame(spark: SparkSession, specs: list[FeatureSpec]) -> DataFrame:
    schema = "feature_name string, theme string, hypothesis string, expected_direction string, calculation_logic string, status string"
    return spark.createDataFrame([(s.name, s.theme, s.hypothesis, s.expected_direction, s.calculation_logic, s.status) for s in specs], schema)


def join_all(key: str, parts: list[DataFrame], anchor: DataFrame) -> DataFrame:
    out = anchor.select(key)
    for p in parts:
        out = out.join(p, key, "left")
    return out


class Velocity(Theme):
    name, description = "velocity", "How fast and how evenly applications follow each other"
    specs = [
        FeatureSpec("velocity_prev_count_7d", "velocity", "many fresh applications mean need", "positive", "count of DAYS_DECISION >= -7", ("previous_application",)),
        FeatureSpec("velocity_prev_count_30d", "velocity", "many recent applications mean need", "positive", "count of DAYS_DECISION >= -30", ("previous_application",)),
        FeatureSpec("velocity_prev_decision_gap_std", "velocity", "uneven gaps mean bursts", "positive", "population deviation of gaps, from 3 decisions", ("previous_application",)),
        FeatureSpec("velocity_bureau_recent_credit_count_30d", "velocity", "fresh credits elsewhere mean load", "positive", "count of DAYS_CREDIT >= -30", ("bureau",)),
    ]

    def build(self, frames, anchor):
        parts = []
        prev, bureau = frame_of(frames, "previous_application"), frame_of(frames, "bureau")
        if prev is not None and "DAYS_DECISION" in prev.columns:
            # equal days first: a key, however hot, has few distinct days, and gaps between equal days are 0
            d = F.col("DAYS_DECISION")
            days = prev.groupBy(CURR, "DAYS_DECISION").agg(F.count("*").alias("__n"))
            gap = (d - F.lag(d).over(Window.partitionBy(CURR).orderBy(d))).cast("double")
            known = F.when(d.isNotNull(), F.col("__n")).otherwise(0)
            days = days.withColumn("__gap", F.when(F.lag(d).over(Window.partitionBy(CURR).orderBy(d)).isNotNull(), gap))
            grouped = days.groupBy(CURR).agg(
                F.sum(F.when(d >= -7, F.col("__n")).otherwise(0)).alias("velocity_prev_count_7d"),
                F.sum(F.when(d >= -30, F.col("__n")).otherwise(0)).alias("velocity_prev_count_30d"),
                (F.sum(known) - 1).cast("double").alias("__gaps"),
                F.coalesce(F.sum("__gap"), F.lit(0.0)).alias("__sum"),
                F.coalesce(F.sum(F.col("__gap") * F.col("__gap")), F.lit(0.0)).alias("__square"),
            )
            spread = F.sqrt(F.greatest(F.col("__gaps") * F.col("__square") - F.col("__sum") * F.col("__sum"), F.lit(0.0))) / nullif0(F.col("__gaps"))
            grouped = grouped.withColumn("velocity_prev_decision_gap_std", F.when(F.col("__gaps") >= 2, spread))
            parts.append(grouped.drop("__gaps", "__sum", "__square"))
        if bureau is not None and "DAYS_CREDIT" in bureau.columns:
            parts.append(bureau.groupBy(CURR).agg(count_if(F.col("DAYS_CREDIT") >= -30).alias("velocity_bureau_recent_credit_count_30d")))
        return join_all(CURR, parts, anchor)


class Consistency(Theme):
    name, description = "consistency", "Whether what applicants state agrees with itself"
    specs = [
        FeatureSpec("consistency_employed_birth_ratio", "consistency", "work longer than life allows is false", "nonlinear", "abs(DAYS_EMPLOYED) / (abs(DAYS_BIRTH) + 1)", ("application",)),
        FeatureSpec("consistency_contact_flag_sum", "consistency", "few contacts mean evasion", "negative", "sum of the present contact flags", ("application",)),
        FeatureSpec("consistency_prev_credit_gap_ratio_mean", "consistency", "credit far from what was asked", "positive", "mean of abs(credit - asked) / (abs(asked) + 1)", ("previous_application",)),
        FeatureSpec("consistency_prev_status_change_rate", "consistency", "unsteady outcomes", "positive", "distinct statuses / applications with an amount", ("previous_application",)),
    ]

    def build(self, frames, anchor):
        parts = []
        app, prev = frame_of(frames, "application"), frame_of(frames, "previous_application")
        if app is not None:
            made = {}
            if {"DAYS_EMPLOYED", "DAYS_BIRTH"} <= set(app.columns):
                made["consistency_employed_birth_ratio"] = F.abs("DAYS_EMPLOYED").cast("double") / (nullif0(F.abs("DAYS_BIRTH").cast("double")) + 1)
            flags = [c for c in ("FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE") if c in app.columns]
            if flags:
                made["consistency_contact_flag_sum"] = sum((F.coalesce(F.col(c), F.lit(0)) for c in flags[1:]), F.coalesce(F.col(flags[0]), F.lit(0)))
            if made:
                parts.append(app.select(CURR, *[x.alias(n) for n, x in made.items()]))
        if prev is not None and {"AMT_CREDIT", "AMT_APPLICATION"} <= set(prev.columns):
            a, c = F.col("AMT_APPLICATION"), F.col("AMT_CREDIT")
            aggs = [F.avg(F.abs(c - a) / (F.abs(a) + 1)).alias("consistency_prev_credit_gap_ratio_mean")]
            if "NAME_CONTRACT_STATUS" in prev.columns:
                aggs.append(ratio(F.count_distinct("NAME_CONTRACT_STATUS"), F.count("AMT_APPLICATION")).alias("consistency_prev_status_change_rate"))
            parts.append(prev.groupBy(CURR).agg(*aggs))
        return join_all(CURR, parts, anchor)


class Cashout(Theme):
    name, description = "cashout", "Cash drawn at once and first payments missed"
    specs = [
        FeatureSpec("cashout_atm_ratio_mean", "cashout", "cash drawings mean distress", "positive", "mean of ATM drawings / (abs(all drawings) + 1)", ("previous_application", "credit_card_balance")),
        FeatureSpec("cashout_first_payment_delinquency_days_max", "cashout", "a late first payment means fraud", "positive", "max of paid less due day, first instalments", ("previous_application", "installments_payments")),
        FeatureSpec("cashout_fpd_severe_flag", "cashout", "a very late first payment means fraud", "positive", "the above over 30", ("previous_application", "installments_payments")),
        FeatureSpec("cashout_installments_late_ratio", "cashout", "late payers stay late", "positive", "share of instalments paid after the due day", ("previous_application", "installments_payments")),
    ]

    def build(self, frames, anchor):
        prev = frame_of(frames, "previous_application")
        card, inst = frame_of(frames, "credit_card_balance"), frame_of(frames, "installments_payments")
        parts = []
        owners = prev.select(PREV, CURR).dropDuplicates()
        if card is not None and {"AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_CURRENT"} <= set(card.columns):
            share = F.col("AMT_DRAWINGS_ATM_CURRENT") / (F.abs("AMT_DRAWINGS_CURRENT") + 1)
            by_prev = card.groupBy(PREV).agg(F.sum(share).alias("__sum"), F.count(share).alias("__n"))
            rolled = by_prev.join(owners, PREV).groupBy(CURR).agg(ratio(F.sum("__sum"), F.sum("__n")).alias("cashout_atm_ratio_mean"))
            parts.append(rolled)
        if inst is not None and {"NUM_INSTALMENT_NUMBER", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT"} <= set(inst.columns):
            late = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
            first = F.col("NUM_INSTALMENT_NUMBER") == 1
            by_prev = inst.groupBy(PREV).agg(
                F.max(F.when(first, late)).alias("__first"), F.max(true_int(first)).alias("__has_first"), F.sum(true_int(late > 0)).alias("__late"), F.count("*").alias("__n")
            )
            rolled = by_prev.join(owners, PREV).groupBy(CURR).agg(F.max("__first").alias("__first"), F.max("__has_first").alias("__has_first"), ratio(F.sum("__late"), F.sum("__n")).alias("cashout_installments_late_ratio"))
            parts.append(
                rolled.select(
                    CURR,
                    F.col("__first").alias("cashout_first_payment_delinquency_days_max"),
                    F.when(F.col("__has_first") == 1, true_int(F.col("__first") > 30)).alias("cashout_fpd_severe_flag"),
                    "cashout_installments_late_ratio",
                )
            )
        return join_all(CURR, parts, anchor)


class ThemeRegistry:
    """Themes by name, in the order of registration."""

    def __init__(self, themes: tuple[Theme, ...] = ()):
        self._themes = {t.name: t for t in themes}

    def register(self, theme: Theme) -> None:
        self._themes[theme.name] = theme

    def get(self, name: str) -> Theme | None:
        return self._themes.get(name)

    def list(self) -> list[str]:
        return list(self._themes)

    def specs(self, names: list[str] | None = None) -> list[FeatureSpec]:
        return [s for n in (names or self.list()) if n in self._themes for s in self._themes[n].specs]


_REGISTRY = ThemeRegistry((Velocity(), Consistency(), Cashout()))


def get_registry() -> ThemeRegistry:
    return _REGISTRY


def register_theme(theme: Theme) -> None:
    _REGISTRY.register(theme)


def list_themes() -> list[str]:
    return _REGISTRY.list()


def get_theme(name: str) -> Theme | None:
    return _REGISTRY.get(name)


def describe_theme(name: str) -> str:
    theme = get_theme(name)
    return theme.description if theme else ""


@dataclass(frozen=True)
class SemanticFeatures:
    matrix: DataFrame
    registry: DataFrame
    skipped: list[str]


def detect_id(df: DataFrame) -> str:
    """The first known id name, else the first name ending in _id, else the first column."""
    return next((c for c in ID_COLUMNS if c in df.columns), None) or next((c for c in df.columns if c.lower().endswith("_id")), df.columns[0])


def semantic_features(frames: dict[str, DataFrame], anchor: DataFrame, themes: list[str] | None = None, key: str | None = None) -> SemanticFeatures:
    """The anchor with the features of each known theme whose tables are all there; names that exist stay."""
    key, out, used, skipped = key or detect_id(anchor), anchor, [], []
    for name in themes or list_themes():
        theme = get_theme(name)
        if theme is None or not theme.available(frames):
            skipped.append(name)
            continue
        features = theme.build(frames, anchor)
        new = [c for c in features.columns if c not in out.columns]
        out, used = out.join(features.select(key, *new), key, "left"), [*used, name]
    return SemanticFeatures(out, registry_frame(anchor.sparkSession, get_registry().specs(used) if used else []), skipped)
