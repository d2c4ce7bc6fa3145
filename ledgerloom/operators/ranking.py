"""Sorts, top-k, exact global row numbers and quintiles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import scratch_path, shared_dir

ACCURACY = 10_000  # a bracket holds about four rows in so many
FEW = 100_000  # so many rows are put in order without a bracket
_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def top_k(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First n rows. ``order`` should end in a unique column so that ties are stable."""
    return df.orderBy(*order).limit(n)


def top_n_per(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First n rows of each group, numbered from 1. Each map task keeps at most n per group."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def best_row(df: DataFrame, key: str, tie: str) -> DataFrame:
    """The row with the largest key; the smallest ``tie`` wins among equals."""
    return top_k(df.filter(F.col(key).isNotNull()), 1, [F.desc(key), F.asc(tie)])


def worst_row(df: DataFrame, key: str, tie: str) -> DataFrame:
    return top_k(df.filter(F.col(key).isNotNull()), 1, [F.asc(key), F.asc(tie)])


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rn", total: str = "n") -> DataFrame:
    """Row number over the whole frame and the number of rows, without a one-task window.

    Rows are range-partitioned and sorted by ``order``, which must be total. A row's number is
    its place in its partition plus the rows in earlier partitions. The sorted partitions are
    checkpointed because range bounds come from a sample and could move on re-evaluation.
    Only one row per partition is gathered for the offsets.
    """
    shared_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftrightunsigned("_place", _LOCAL_BITS))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias(total),
    )
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)) + 1
    # one row per partition of the frame: small enough to broadcast at any scale
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + local)
        .drop("_part", "_place", "_before")
    )


def ntile_of(rn: Column, n: Column, buckets: int = 5) -> Column:
    """NTILE bucket of row number rn among n rows: the first n mod buckets get one row more."""
    size = F.floor(n / buckets)
    longer = F.pmod(n, F.lit(buckets))
    in_longer = longer * (size + 1)
    return (
        F.when(rn <= in_longer, F.ceil(rn / (size + 1)))
        .otherwise(longer + F.ceil((rn - in_longer) / F.greatest(size, F.lit(1))))
        .cast("int")
    )


def quantile_bin_of(rn: Column, n: Column, bins: int = 5) -> Column:
    """Bin of row number rn when 1..n is cut at its linear quantiles, bins closed on the right."""
    raised = (rn - 1) * bins
    steps = F.greatest(n - 1, F.lit(1))
    return F.greatest(F.lit(1), F.ceil(raised / steps)).cast("int")


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the session's shared folder, so that several passes read it and none computes it."""
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rows_up_to(rule, n: int, buckets: int) -> list[int]:
    """How many of n rows the first 1, 2, ... buckets - 1 buckets of a rule hold together."""
    if rule is ntile_of:
        return [k * (n // buckets) + min(k, n % buckets) for k in range(1, buckets)]
    if rule is quantile_bin_of:
        return [k * (n - 1) // buckets + 1 for k in range(1, buckets)]
    raise ValueError("rule is ntile_of or quantile_bin_of")


@dataclass
class _Cut:
    """A row looked for: the ``rank``-th of the ``n`` rows that meet ``among``, by keys still to be compared."""

    column: str
    rank: int
    n: int
    among: Column
    value: object = None
    key: Column | None = None
    over: Column | None = None  # whether a row lies behind the one looked for


def _select(df: DataFrame, cuts: Sequence[_Cut]) -> list[tuple[object, int, int]]:
    """(value of ``key``, rows before it, rows with it) at each cut's rank, without a sort of all rows.

    An approximate quantile brackets each rank, one pass counts what lies below the brackets, another
    counts the distinct values within; only those are put in order. Few rows are taken as a whole.
    """
    below = [0] * len(cuts)
    inside = [c.among for c in cuts]
    wide = [i for i, c in enumerate(cuts) if c.n > FEW]
    if wide:
        near = [[max(0.0, cuts[i].rank / cuts[i].n - 2 / ACCURACY), min(1.0, cuts[i].rank / cuts[i].n + 2 / ACCURACY)] for i in wide]
        found = df.agg(*[F.percentile_approx(F.when(cuts[i].among, cuts[i].key), p, ACCURACY).alias(f"c{i}") for i, p in zip(wide, near)]).first()
        brackets = {i: [F.lit(x) for x in found[f"c{i}"]] for i in wide}
        counts = df.agg(*[
            F.count(F.when(cuts[i].among & test, 1)).alias(f"{name}{i}") for i, (lo, hi) in brackets.items()
            for name, test in (("below", cuts[i].key < lo), ("upto", cuts[i].key <= hi))
        ]).first()
        for i, (lo, hi) in brackets.items():
            if counts[f"below{i}"] < cuts[i].rank <= counts[f"upto{i}"]:  # else the bracket missed: all rows count
                below[i], inside[i] = counts[f"below{i}"], inside[i] & (cuts[i].key >= lo) & (cuts[i].key <= hi)
    held = [F.when(test, F.struct(F.lit(i).alias("cut"), c.key.alias("key"))) for i, (c, test) in enumerate(zip(cuts, inside))]
    values = df.select(F.inline(F.array_compact(F.array(*held)))).groupBy("cut", "key").agg(F.count("*").alias("c"))
    so_far = F.sum("c").over(Window.partitionBy("cut").orderBy("key"))
    ranks = F.array(*[F.lit(c.rank - b) for c, b in zip(cuts, below)])
    hit = values.withColumn("upto", so_far).filter((F.col("upto") >= F.get(ranks, "cut")) & (F.col("upto") - F.col("c") < F.get(ranks, "cut")))
    told = {r["cut"]: r for r in hit.collect()}
    return [(told[i]["key"], below[i] + told[i]["upto"] - told[i]["c"], told[i]["c"]) for i in range(len(cuts))]


def _id_keys(df: DataFrame, key: str) -> list[Column]:
    """Numbers that order rows as ``key`` does, one after the other: the number itself, or seven bytes of a text at a time."""
    if not isinstance(df.schema[key].dataType, StringType):
        return [F.col(key)]
    longest = df.agg(F.max(F.octet_length(key))).first()[0] or 0
    piece = [F.rpad(F.hex(F.substring(F.encode(key, "UTF-8"), at, 7)), 14, "0") for at in range(1, longest + 1, 7)]
    return [F.conv(p, 16, 10).cast("bigint") for p in piece] or [F.lit(0).cast("bigint")]


def global_scores(df: DataFrame, key: str, columns: Sequence[str], rule, buckets: int = 5) -> DataFrame:
    """``df`` with a column ``<name>_bucket`` for each numeric column: the bucket of its row number.

    Rows are numbered by (value with null last, key); ``key`` is unique and not null, a whole number or a
    text. ``rule`` is ``ntile_of`` or ``quantile_bin_of``. No row is numbered: the last row of each bucket is
    selected, by value first and by key among the rows of that value, for all buckets of all columns
    in the same few passes over ``df``, which is written once. A row's bucket is the number of those rows before it.
    """
    df = _written(df)
    value = {c: F.col(c).cast("decimal(38,6)") for c in columns}
    told = df.agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in columns]).first()
    cuts = []
    for c in columns if told["n"] else ():
        for rank in _rows_up_to(rule, told["n"], buckets):
            null = rank > told[c]
            among = value[c].isNull() if null else value[c].isNotNull()
            over = F.lit(False) if null else value[c].isNull()
            cuts.append(_Cut(c, rank - told[c] if null else rank, told["n"] - told[c] if null else told[c], among, None, None if null else value[c], over))
    keys = _id_keys(df, key) if cuts else []
    for level in [None, *keys]:
        now = [c for c in cuts if level is not None or c.key is not None]
        for c in now:
            c.key = c.key if level is None else level
        if level is not None and level is not keys[0]:
            now = [c for c in now if c.n > 1]
        if not now:
            continue
        for c, (found, before, equal) in zip(now, _select(df, now)):
            at = F.lit(found).cast("decimal(38,6)" if level is None else "bigint")
            c.over = c.over | (c.among & (c.key > at))
            c.among, c.rank, c.n = c.among & (c.key == at), c.rank - before, equal
    behind = {c: [F.coalesce(x.over, F.lit(False)).cast("int") for x in cuts if x.column == c] for c in columns}
    return df.withColumns({f"{c}_bucket": sum(behind[c], F.lit(1)) for c in columns})
