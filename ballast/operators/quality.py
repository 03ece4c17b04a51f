"""Declared keys and rules as queries that return the offending rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.functions.money import amount
from ballast.functions.sizing import sized_broadcast, staged
from ballast.schemas import FOREIGN_KEYS, KEYS, TABLES, UNIQUE


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def fk_violations(child: DataFrame, parent: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Child rows without a parent; a NULL in the key passes."""
    cols = list(cols)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return child.filter(complete).join(parent.select(*cols).distinct(), cols, "left_anti")


def null_violations(df: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per NULL in a NOT NULL column, with the column's name."""
    missing: list[Column] = [F.when(F.col(c).isNull(), F.lit(c)) for c in cols]
    return df.select(
        *key, F.explode(F.array_compact(F.array(*missing))).alias("column_name")
    )


def weight_check(model_asset: DataFrame) -> DataFrame:
    """Models whose weights do not sum to one."""
    return (
        model_asset.groupBy("model_id")
        .agg(amount(F.sum("weighting")).alias("weight"))
        .filter(F.col("weight") != 1)
    )


def _complete(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def _value(cols: Sequence[str]) -> Column:
    """A key's columns as one text that differs for different keys."""
    return F.to_json(F.struct(*cols))


def _shown(cols: Sequence[str]) -> Column:
    return F.concat_ws("/", *[F.col(c).cast("string") for c in cols])


def duplicate_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Values of every declared key that occur more than once: one grouped count of all
    keys of all tables."""
    rows = [
        df.select(
            F.lit(name).alias("operator"), F.lit(",".join(key)).alias("rule"),
            _value(key).alias("value"), _shown(key).alias("key"),
        )
        for name, df in tables.items()
        for key in [KEYS.get(name, []), *UNIQUE.get(name, [])]
        if key
    ]
    counted = (
        reduce(DataFrame.unionByName, rows)
        .groupBy("operator", "rule", "value")
        .agg(F.count("*").alias("n"), F.first("key").alias("key"))
    )
    return counted.filter(F.col("n") > 1).select(
        "operator", "key", F.concat(F.lit("not unique: "), F.col("rule")).alias("reason")
    )


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows without the parent that a declared rule asks for; a null in the key passes.

    The keys of all rules are tagged and made distinct, which leaves one of a key that very
    many rows have, and meet all parents' keys in one join. Only broken keys go back to
    the rows."""
    rules = [
        (no, child, parent, shared)
        for no, (child, parent, shared) in enumerate(FOREIGN_KEYS)
        if child in tables and parent in tables
    ]
    if not rules:
        return next(iter(tables.values())).limit(0).select(
            *[F.lit("").alias(c) for c in ("operator", "key", "reason")]
        )

    def tag(parent: str, shared: Sequence[str]) -> Column:
        return F.lit(f"{parent}({','.join(shared)})").alias("parent")

    asked = [
        tables[child].filter(_complete(shared)).select(
            F.lit(no).alias("rule"), tag(parent, shared), _value(shared).alias("value")
        )
        for no, child, parent, shared in rules
    ]
    have = [
        tables[parent].select(tag(parent, shared), _value(shared).alias("value"))
        for parent, shared in {(p, tuple(s)) for _, _, p, s in rules}
    ]
    missing = reduce(DataFrame.unionByName, asked).distinct().join(
        reduce(DataFrame.unionByName, have), ["parent", "value"], "left_anti"
    )
    broken = sized_broadcast(staged(missing.select("rule", "value"), "broken"))
    rows = [
        tables[child].filter(_complete(shared)).select(
            F.lit(no).alias("rule"), _value(shared).alias("value"), F.lit(child).alias("operator"),
            _shown([*KEYS.get(child, []), *shared]).alias("key"),
            F.lit(f"no such {parent}: {','.join(shared)}").alias("reason"),
        )
        for no, child, parent, shared in rules
    ]
    return (
        reduce(DataFrame.unionByName, rows)
        .join(broken, ["rule", "value"])
        .select("operator", "key", "reason")
    )


def declared_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Every broken rule of the given stored tables: keys, NOT NULL columns and the
    foreign keys between them, in the shape of :func:`reject`."""
    nulls = []
    for name, df in tables.items():
        key = KEYS.get(name, [])
        required = [f.name for f in TABLES[name].fields if not f.nullable and f.name in df.columns]
        if required:
            missing = null_violations(df, key, required)
            cols = [F.col(c) for c in [*key, "column_name"]]
            nulls.append(reject(missing, name, cols, "value is missing"))
    return reduce(DataFrame.unionByName, nulls, duplicate_keys(tables)).unionByName(orphans(tables))


def reject(df: DataFrame, operator: str, key: Sequence[Column], reason: str) -> DataFrame:
    """Rows set aside, in the common shape ``operator, key, reason``."""
    return df.select(
        F.lit(operator).alias("operator"),
        F.concat_ws("/", *[k.cast("string") for k in key]).alias("key"),
        F.lit(reason).alias("reason"),
    )
