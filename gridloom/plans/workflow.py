"""The cleaning workflow: six optional steps in a fixed order, then learned steps on train."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.storage import cut_lineage
from ..operators import clean
from ..operators.prepare import Preparation, fit_preparation
from ..operators.split import SPLIT, TRAIN, split_train_test


@dataclass(frozen=True)
class Workflow:
    """Each field holds the arguments of a step, or None to leave the step out."""

    missing: dict | None = None
    duplicates: bool = False
    outliers: dict | None = None
    encode: dict | None = None
    scale: dict | None = None
    split: dict | None = None

    def clean(self, df: DataFrame) -> DataFrame:
        """Missing, duplicates, outliers, encoding, scaling: each step feeds the next."""
        if self.missing:
            df = clean.handle_missing(df, **self.missing)
        if self.duplicates:
            df = clean.remove_duplicates(df)
            if self.outliers or self.encode or self.scale:
                # The steps below read the table several times: shuffle it only once.
                df = cut_lineage(df)
        if self.outliers:
            df = clean.remove_outliers(df, **self.outliers)
        if self.encode:
            df = clean.encode_categorical(df, **self.encode)
        if self.scale:
            df = clean.scale_numeric(df, **self.scale)
        return df

    def run(self, df: DataFrame) -> DataFrame:
        """The cleaned table, with a ``split`` column when a split is asked for."""
        cleaned = self.clean(df)
        return split_train_test(cleaned, **self.split) if self.split else cleaned

    def fit_on_train(self, raw: DataFrame) -> tuple[DataFrame, Preparation | None]:
        """Split the raw table and learn the steps again from its training side only."""
        if not self.split:
            raise ValueError("A preparation is learned from a split: set the split step.")
        split = split_train_test(raw, **self.split)
        train = split.filter(split[SPLIT] == TRAIN).drop(SPLIT)
        missing = self.missing or {}
        strategy = missing.get("strategy", "median")
        impute = [] if strategy in ("drop rows", "drop columns") else missing.get("columns")
        encode, scale = self.encode or {}, self.scale or {}
        fitted = fit_preparation(
            train,
            impute_columns=impute,
            impute_strategy=strategy,
            impute_fill_value=missing.get("fill_value"),
            encode_columns=encode.get("columns"),
            encode_method=encode.get("method", "one-hot"),
            scale_columns=scale.get("columns"),
            scale_method=scale.get("method", "StandardScaler"),
        )
        return split, fitted
