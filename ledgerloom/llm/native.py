"""Column expressions that several operators share: words, letting a value be used twice, row keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of non-blank characters of a text, in order; an empty array for null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def lower_ascii(text: Column) -> Column:
    """A-Z become a-z, all else stays (``lower`` would also change other alphabets)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text: Column) -> Column:
    """16 bytes that stand for a text; null stands for itself."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def set_aside(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but ``used`` named _0, _1, ..., and what selects all columns as they were.

    So no column of a caller, whatever its name, meets a name that an operator uses inside.
    """
    new = [c if c in used else f"_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*new), [F.col(n).alias(c) for n, c in zip(new, docs.columns)]


def without(items: Column, places: Column) -> Column:
    """The items of an array whose positions are not in ``places``, in time linear in both."""
    return let(items, lambda x: F.when(F.size(x) == 0, x).otherwise(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), places), lambda i: F.get(x, i))))


def groups_of(items: Column, width: Column) -> Column:
    """An array in consecutive groups of ``width`` items; the last may be shorter."""
    count = F.ceil(F.size(items) / width).cast("int")
    return F.when(F.size(items) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), count - 1))


def running(numbers: Column, depth: int = 2) -> Column:
    """For each number, the sum of those before it (int), in n ** (1 + 1 / (depth + 1)) steps.

    Lambdas of Spark have no state to carry and appending to an array copies it, so a plain fold takes
    n * n steps. Here the array is cut into groups; sums of groups and sums inside groups are added.
    """

    def plain(x: Column) -> Column:
        return F.transform(x, lambda _, i: F.aggregate(F.slice(x, 1, i), F.lit(0), lambda a, y: a + y))

    def grouped(x: Column) -> Column:
        width = F.greatest(F.ceil(F.pow(F.size(x), F.lit(depth / (depth + 1)))).cast("int"), F.lit(1))

        def cut(w: Column) -> Column:
            return F.transform(groups_of(x, w), lambda k: F.slice(x, k * w + 1, w))

        def added(g: Column) -> Column:
            totals = F.transform(g, lambda y: F.aggregate(y, F.lit(0), lambda a, z: a + z))
            return let(let(totals, plain), lambda before: F.flatten(
                F.transform(g, lambda y, k: F.transform(running(y, depth - 1), lambda z: z + F.get(before, k)))))

        return let(let(width, cut), added)

    return let(numbers, plain if depth == 0 else grouped)
