"""How tables are connected where no key is declared.

A column can point at another if every value of it occurs there once. All values of all columns
are grouped once; the columns that share a value become a bit set, and columns that occur in a set
together are counted per pair. Nothing is compared table by table.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns per LONG of a bit set; the sign is left alone.
WORD = 62


def _kind(data_type: T.DataType) -> str | None:
    """Values of one kind can be equal; other types are no keys."""
    if isinstance(data_type, T.IntegralType):
        return "number"
    return "text" if isinstance(data_type, T.StringType) else None


def values(tables: Mapping[str, DataFrame]) -> tuple[list[tuple[str, str]], DataFrame]:
    """The columns that may be keys, and per kind, value and column its number of rows."""
    columns: list[tuple[str, str]] = []
    parts = []
    for table, df in tables.items():
        cells = []
        for f in df.schema.fields:
            if (kind := _kind(f.dataType)) is not None:
                cells.append(
                    F.struct(
                        F.lit(len(columns)).alias("c"),
                        F.lit(kind).alias("kind"),
                        F.col(f"`{f.name}`").cast("string").alias("v"),
                    )
                )
                columns.append((table, f.name))
        if cells:
            parts.append(df.select(F.inline(F.array(*cells))))
    if not parts:
        raise ValueError("no column of a number or text type")
    # Rows of one value combine on the map side, so a frequent value is a row per task.
    counted = (
        reduce(DataFrame.unionAll, parts)
        .where("v IS NOT NULL")
        .groupBy("kind", "v", "c")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return columns, counted


def find_connections(tables: Mapping[str, DataFrame], least: float = 1.0) -> DataFrame:
    """Pairs of columns of which the parent's values are unique and hold the child's.

    `least` is the part of the child's distinct values that the parent must hold: 1.0 for keys
    that hold throughout, less to see keys with orphans. Numbers of any width are compared with
    one another, text with text; NULLs do not count. A pair may hold by chance, as small
    numbers do; `child_values` and `parent_values` help to tell.
    """
    columns, counted = values(tables)
    n = len(columns)
    words = [f"w{i}" for i in range(-(-n // WORD))]

    def bit(c: Column, word: int) -> Column:
        inside = (c >= word * WORD) & (c < (word + 1) * WORD)
        one = F.call_function("shiftleft", F.lit(1).cast("long"), c - F.lit(word * WORD))
        return F.when(inside, one).otherwise(F.lit(0).cast("long"))

    sets = counted.groupBy("kind", "v").agg(
        *(F.bit_or(bit(F.col("c"), i)).alias(w) for i, w in enumerate(words)),
        F.collect_list(F.struct("c", "rows")).alias("cells"),  # one per column at most
    )
    # From here on rows are few: one per bit set that occurs and column in it.
    found = (
        sets.select(*words, F.inline("cells"))
        .groupBy(*words, "c")
        .agg(
            F.count(F.lit(1)).alias("values"),
            F.sum("rows").alias("rows"),
            F.max("rows").alias("most"),
        )
    )
    together = F.filter(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda b: reduce(
            lambda out, i: out | (bit(b, i).bitwiseAND(F.col(words[i])) != 0), range(len(words)), F.lit(False)
        ),
    )
    pairs = (
        found.withColumn("p", F.explode(together))
        .groupBy("c", "p")
        .agg(F.sum("values").alias("values"), F.sum("rows").alias("rows"), F.max("most").alias("most"))
    )
    alone = pairs.where("c = p")
    child = alone.select("c", F.col("values").alias("child_values"), F.col("rows").alias("child_rows"))
    parent = alone.where("most = 1").select("p", F.col("values").alias("parent_values"))
    names = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(c).alias("c")) for t, c in columns))

    def name(position: str, part: str) -> Column:
        return F.get(names, F.col(position))[part]

    return (
        pairs.where("c <> p")
        .join(child, "c")
        .join(parent, "p")
        .where(F.col("values") >= F.lit(least) * F.col("child_values"))
        .select(
            name("c", "t").alias("child_table"),
            name("c", "c").alias("child_column"),
            name("p", "t").alias("parent_table"),
            name("p", "c").alias("parent_column"),
            "child_values",
            "parent_values",
            F.col("values").alias("matched_values"),
            (F.col("child_rows") - F.col("rows")).alias("orphan_rows"),
        )
    )
