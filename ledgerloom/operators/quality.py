"""Table constraints as checks that count their violations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _unpivot(row: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    """A one-row frame turned into (label, value) rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias(label), F.col(f"`{n}`").alias(value)) for n in names])
    return row.select(F.inline(pairs))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, violations), all columns counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _unpivot(counts, columns, "column_name", "violations")


def check_predicates(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations). As in a SQL CHECK, a rule that is NULL is not violated."""
    counts = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return _unpivot(counts, list(rules), "rule", "violations")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def check_foreign_key(child: DataFrame, parent: DataFrame, on: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent row, with their number of child rows.

    Child rows are counted per key before the join, so no key is joined more than once.
    """
    keys = child.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("n_rows"))
    parents = parent.select(F.col(parent_key or on).alias(on))
    return keys.join(parents, on, "left_anti")


def foreign_key_summary(links: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """(link, orphan_keys, orphan_rows) for each named (child, parent, key).

    Rows of a child are counted once per key column, however many parents that key is held against.
    """
    grouped: dict[tuple[int, str], list[str]] = {}
    for name, (child, _, on) in links.items():
        grouped.setdefault((id(child), on), []).append(name)
    parts = []
    for (_, on), names in grouped.items():
        child = links[names[0]][0]
        keys = child.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("n_rows"))
        for name in names:
            known = links[name][1].select(F.col(on)).distinct().withColumn(f"has_{name}", F.lit(True))
            keys = keys.join(known, on, "left")
        facts = []
        for name in names:
            orphan = F.col(f"has_{name}").isNull()
            facts += [F.count_if(orphan).alias(f"k_{name}"), F.coalesce(F.sum(F.when(orphan, F.col("n_rows"))), F.lit(0)).alias(f"r_{name}")]
        rows = [F.struct(F.lit(n).alias("link"), F.col(f"k_{n}").alias("orphan_keys"), F.col(f"r_{n}").alias("orphan_rows")) for n in names]
        parts.append(keys.agg(*facts).select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def require_rows(df: DataFrame, what: str = "result") -> DataFrame:
    """The frame itself, or an error when it has no rows. Looks at once, so it is for frames that are cheap to begin."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}: check the source files")
    return df


def require_count(counted: DataFrame, column: str, what: str = "result") -> DataFrame:
    """A frame of counts that fails, when it is run, on a count of 0: no pass of its own."""
    message = f"no rows in {what}: check the source files"
    checked = F.when(F.col(column) > 0, F.col(column)).otherwise(F.raise_error(F.lit(message)).cast("long"))
    return counted.withColumn(column, checked)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table."""
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


class Watch:
    """Rows and violations of one table, counted by the tasks that write it.

    ``on`` has to be the last step before the write: the tasks of a write count once, however often they are
    repeated, while tasks before a shuffle may run and count again when an executor is lost. A watch
    serves one write; ``counts`` waits for it. A rule that is NULL is not violated, as in ``check_predicates``.
    """

    def __init__(self, name: str, not_null: Sequence[str] = (), rules: dict[str, Column] | None = None):
        self.name = name
        self._seen = Observation()
        self._metrics = {"rows": F.count(F.lit(1))}
        self._metrics |= {f"{c} is null": F.count_if(F.col(c).isNull()) for c in not_null}
        self._metrics |= {rule: F.count_if(~holds) for rule, holds in (rules or {}).items()}

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *[metric.alias(check) for check, metric in self._metrics.items()])

    def counts(self) -> dict[str, int]:
        """{check: rows or violations}; zeros for a table without rows."""
        seen = self._seen.get
        return {check: seen.get(check) or 0 for check in self._metrics}


def watched(spark: SparkSession, watches: dict[str, Watch]) -> DataFrame:
    """(table_name, check_name, n_rows) of finished writes; one row for each check, so a small frame."""
    found = [(w.name, check, n) for w in watches.values() for check, n in w.counts().items()]
    return spark.createDataFrame(found, "table_name STRING, check_name STRING, n_rows BIGINT")


def require_clean(watches: dict[str, Watch]) -> None:
    """Fails on a written table without rows or with violations; names all of them."""
    wrong = [f"{w.name}: {check} {n}" for w in watches.values() for check, n in w.counts().items() if (n == 0) == (check == "rows")]
    if wrong:
        raise ValueError("checks failed: " + ", ".join(wrong))
