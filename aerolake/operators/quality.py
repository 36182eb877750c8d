"""Contract checks: NOT NULL, VARCHAR length, key uniqueness per batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.contracts import TableContract


class DuplicateKeyError(ValueError):
    """A publish batch holds a key more than once (the database would reject it)."""


class ContractError(ValueError):
    """A publish batch breaks a NOT NULL or length rule of its table."""


def _rules(contract: TableContract) -> list[tuple[str, Column]]:
    """Name and violation condition of the rules that one row can break."""
    missing = [(f"not_null:{c}", F.col(c).isNull()) for c in contract.not_null]
    return missing + [(f"max_len:{c}", F.length(F.col(c)) > n) for c, n in contract.max_len.items()]


def contract_violations(
    df: DataFrame,
    contract: TableContract,
    *,
    batch_columns: Sequence[str] = (),
    label: str | None = None,
) -> DataFrame:
    """One row per rule: ``(table_name, rule, violations)``.

    One pass: rows are grouped by (publish batch, key) with partial
    aggregation, each group carries its NOT NULL / length violation counts
    and its size, and a final global aggregate sums them and counts keys held
    by more than one row within a publish batch (``batch_columns``, e.g. the
    run instant).  The input is computed once, not once per rule.
    """
    name = label or contract.name
    checks = _rules(contract)
    per_key = df.groupBy(*batch_columns, *contract.keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(cond).alias(f"c{i}") for i, (_, cond) in enumerate(checks)],
    )
    totals = per_key.agg(
        *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(checks))],
        F.count_if(F.col("_rows") > 1).alias("dup"),
    )
    pairs = [f"'{rule}', c{i}" for i, (rule, _) in enumerate(checks)] + ["'unique_key', dup"]
    stack = f"stack({len(pairs)}, {', '.join(pairs)}) as (rule, violations)"
    return totals.selectExpr(stack).select(
        F.lit(name).alias("table_name"),
        "rule",
        F.coalesce(F.col("violations").cast("bigint"), F.lit(0).cast("bigint")).alias("violations"),
    )


@dataclass(frozen=True)
class CheckedTable:
    """A table to check, its contract, and the columns that tell its publish batches apart."""

    rows: DataFrame
    contract: TableContract
    batch_columns: Sequence[str] = field(default=())
    label: str | None = None

    @property
    def name(self) -> str:
        return self.label or self.contract.name


def tables_violations(tables: Sequence[CheckedTable]) -> DataFrame:
    """``contract_violations`` of several tables (names must differ) in one pass: one shuffle of their keys.

    Each row gives its table, its publish batch and key as texts (NULL stays NULL) and a 0 or 1
    for each rule it breaks.  These are summed by key, with partial aggregation (a key that
    holds a third of the rows is one row a task), then by table.  An empty table breaks nothing.
    """
    names = [t.name for t in tables]
    if not tables or len(set(names)) < len(names):
        raise ValueError(f"tables to check need names that differ: {names}")
    rules = [_rules(t.contract) for t in tables]
    width = max(map(len, rules))
    counters = [f"c{i}" for i in range(width)]

    def judged(table: CheckedTable, checks: list[tuple[str, Column]]) -> DataFrame:
        broken = [F.when(cond, 1).otherwise(0) for _, cond in checks] + [F.lit(0)] * (width - len(checks))
        key = F.array(*[F.col(c).cast("string") for c in [*table.batch_columns, *table.contract.keys]])
        return table.rows.select(F.lit(table.name).alias("table_name"), key.alias("key"), F.lit(1).alias("held"), *[b.alias(c) for b, c in zip(broken, counters)])

    # a row without a key for each table, so that empty ones are told as well
    labels = F.element_at(F.array(*map(F.lit, names)), (F.col("id") + 1).cast("int")).alias("table_name")
    nothing = tables[0].rows.sparkSession.range(len(names)).select(labels, F.lit(None).cast("array<string>").alias("key"), *[F.lit(0).alias(c) for c in ("held", *counters)])
    rows = reduce(DataFrame.unionByName, [judged(t, r) for t, r in zip(tables, rules)], nothing)
    per_key = rows.groupBy("table_name", "key").agg(*[F.sum(c).alias(c) for c in ("held", *counters)])
    totals = per_key.groupBy("table_name").agg(F.count_if(F.col("held") > 1).alias("dup"), *[F.sum(c).alias(c) for c in counters])
    told = F.lit(None)
    for name, checks in zip(names, rules):
        pairs = [(rule, f"c{i}") for i, (rule, _) in enumerate(checks)] + [("unique_key", "dup")]
        found = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(c).alias("violations")) for rule, c in pairs])
        told = F.when(F.col("table_name") == name, found).otherwise(told)
    return totals.select("table_name", F.inline(told))


def assert_unique_keys(batch: DataFrame, keys: Sequence[str]) -> None:
    """Raise before any write if a key occurs twice in the batch."""
    dup = batch.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate key in batch: {dup[0].asDict()}")


def enforce_contract(batch: DataFrame, contract: TableContract, *, keys_unique: bool = False) -> None:
    """Raise before any write if the batch breaks its table's contract.

    NOT NULL and length rules are counted map-side in one pass.  ``keys_unique`` says
    that the batch comes from a fold over the keys, which saves the shuffle of the key check.
    """
    checks = _rules(contract)
    counts = batch.agg(*[F.count_if(broken).alias(rule) for rule, broken in checks]).first().asDict()
    broken = {rule: n for rule, n in counts.items() if n}
    if broken:
        raise ContractError(f"{contract.name}: {broken}")
    if not keys_unique:
        assert_unique_keys(batch, contract.keys)
