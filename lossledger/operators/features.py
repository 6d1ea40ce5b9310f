"""Feature selection and typing for the three models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.functions.numeric import parse_number
from lossledger.operators.leakage import text_columns

MIN_NUMERIC_SHARE = 0.80

# Columns never used as features, and PD name parts that exclude a column.
PD_KEYS = ["facility_id", "company_id", "observation_date", "target_default_12m"]
PD_LEAKAGE = [
    "default_date", "default_type", "dpd_at_default", "ead_at_default", "writeoff_flag", "max_dpd_observed",
    "max_dpd_12m", "target_default_12m", "realized_lgd", "realized_ccf", "total_recovery_amount",
    "total_collection_cost", "recovery_events_count",
]
PD_SUSPICIOUS_TOKENS = ["target", "default_date", "ead_at_default", "realized_lgd", "realized_ccf", "recovery", "dpd"]
LGD_KEYS = ["facility_id", "company_id", "default_date", "realized_lgd"]
LGD_LEAKAGE = [
    "total_recovery_amount", "total_collection_cost", "net_recovery_amount", "recovery_events_count", "writeoff_flag",
]
CCF_KEYS = ["facility_id", "company_id", "default_date", "realized_ccf"]
CCF_LEAKAGE = [
    "ead_at_default", "default_type", "dpd_at_default", "writeoff_flag", "realized_lgd", "total_recovery_amount",
    "total_collection_cost", "net_recovery_amount", "recovery_events_count",
]


def pd_features(columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """PD features, and the columns excluded for a suspicious name."""
    candidates = [c for c in columns if c not in {*PD_KEYS, *PD_LEAKAGE}]
    suspicious = [c for c in candidates if any(token in c.lower() for token in PD_SUSPICIOUS_TOKENS)]
    return [c for c in candidates if c not in suspicious], suspicious


def lgd_features(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in {*LGD_KEYS, *LGD_LEAKAGE}]


def ccf_features(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in {*CCF_KEYS, *CCF_LEAKAGE}]


def feature_types(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric and categorical features by column type."""
    numeric = [c for c in features if isinstance(df.schema[c].dataType, T.NumericType)]
    return numeric, [c for c in features if c not in numeric]


def numeric_features(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    """Numeric columns of `df` outside `excluded`."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in set(excluded)]


def numeric_like_profile(df: DataFrame, protected: Sequence[str] = ()) -> DataFrame:
    """Per text column: filled values, and those that read as numbers. One aggregate over all columns."""
    columns = [c for c in text_columns(df) if c not in set(protected)]
    counted = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.count(c).alias("filled"),
                    F.count(parse_number(F.col(c))).alias("numeric"),
                )
                for c in columns
            ]
        ).alias("profile")
    )
    return counted.select(F.inline("profile"))


def coerce_numeric_like(
    df: DataFrame, protected: Sequence[str] = (), min_numeric_share: float = MIN_NUMERIC_SHARE
) -> DataFrame:
    """Turn text columns that are mostly numbers into doubles; other texts stay."""
    if not [c for c in text_columns(df) if c not in set(protected)]:
        return df
    profile = numeric_like_profile(df, protected).collect()
    mostly = [r["column"] for r in profile if r["filled"] and r["numeric"] / r["filled"] >= min_numeric_share]
    return df.withColumns({c: parse_number(F.col(c)) for c in mostly})


def choose_pd_column(columns: Sequence[str], best_model: str | None = None) -> str:
    """The best model's score column, else the first score that is not the prior."""
    if best_model is not None and f"pd_{best_model}" in columns:
        return f"pd_{best_model}"
    scores = [c for c in columns if c.startswith("pd_") and c != "pd_dummy_prior"]
    if not scores:
        raise ValueError("no PD prediction columns found")
    return scores[0]
