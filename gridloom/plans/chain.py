"""Feature operations as data: record, replay, undo."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import features as fe

# Operation key -> function.
OPERATIONS = {
    "numeric": fe.create_numeric_feature,
    "math": fe.apply_math_transform,
    "bin": fe.bin_numeric,
    "datetime": fe.extract_datetime_features,
    "text": fe.extract_text_features,
    "interaction": fe.create_interaction,
    "polynomial": fe.create_polynomial_features,
    "variance": fe.select_by_variance,
    "correlation": fe.select_by_correlation,
}


def apply_feature_op(df: DataFrame, op: dict) -> DataFrame:
    """Run one ``{"key": ..., "params": {...}}`` operation."""
    if op["key"] not in OPERATIONS:
        raise ValueError(f"`{op['key']}` is not in the list of operations.")
    return OPERATIONS[op["key"]](df, **op["params"])


@dataclass(frozen=True)
class Failure:
    """The operation that ended a replay: its place from 0, its key, and what it said."""

    step: int
    key: str
    error: str


def replay_ops(df: DataFrame, ops: list[dict]) -> tuple[DataFrame, Failure | None]:
    """Replay operations from the original table; the first that fails ends the chain."""
    for step, op in enumerate(ops):
        try:
            df = apply_feature_op(df, op)
        except (ValueError, KeyError) as error:
            return df, Failure(step, str(op.get("key")), str(error))
    return df, None


def fold_ops(df: DataFrame, ops: list[dict]) -> DataFrame:
    return replay_ops(df, ops)[0]


@dataclass(frozen=True)
class OpChain:
    """An immutable list of operations: adding, undoing and resetting give a new one."""

    ops: tuple[dict, ...] = ()

    def add(self, key: str, **params) -> OpChain:
        return OpChain((*self.ops, {"key": key, "params": params}))

    def undo(self) -> OpChain:
        return OpChain(self.ops[:-1])

    def reset(self) -> OpChain:
        return OpChain()

    def replay(self, df: DataFrame) -> DataFrame:
        return fold_ops(df, list(self.ops))
