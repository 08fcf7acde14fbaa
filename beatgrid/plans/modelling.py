"""Counts and rates to a fitted and validated model."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.operators.regression import Fit, cv_means, kfold_cv, ols, regression_frame
from beatgrid.sources.staging import materialise

PREDICTORS = ("rate", "population")


def district_year_key() -> Column:
    return F.concat_ws("|", F.col("district"), F.col("year").cast("string"))


def fit_counts(counts: DataFrame, rates: DataFrame, skeleton: DataFrame) -> Fit:
    """Counts on year effects, rate and population."""
    return ols(regression_frame(counts, rates, skeleton), "count", PREDICTORS, "year")


def validate_counts(frame: DataFrame, k: int = 10) -> DataFrame:
    """Fold metrics, and their means as fold -1. The frame is written once, as fits and level effects both read it."""
    folds = kfold_cv(materialise(frame, "cv-frame"), "count", PREDICTORS, "year", district_year_key(), k)
    return folds.unionByName(cv_means(folds))
