"""Key constraints as checks that raise before anything is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


class ConstraintError(ValueError):
    pass


def assert_unique(df: DataFrame, keys: list[str], name: str = "table") -> None:
    bad = df.groupBy(*keys).count().where("count > 1").limit(3).collect()
    if bad:
        raise ConstraintError(f"{name}: {keys} not unique: {[tuple(r)[:-1] for r in bad]}")


def assert_not_null(df: DataFrame, columns: list[str], name: str = "table") -> None:
    found = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    if bad := {c: n for c, n in found.items() if n}:
        raise ConstraintError(f"{name}: nulls in {bad}")


def assert_fk(child: DataFrame, parent: DataFrame, key: str, name: str = "table") -> None:
    bad = child.join(parent.select(key), key, "left_anti").select(key).limit(3).collect()
    if bad:
        raise ConstraintError(f"{name}: {key} without a parent: {[r[0] for r in bad]}")
