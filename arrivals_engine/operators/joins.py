"""Left lookup join that broadcasts only what was measured to be small."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: So many codes of a column are told as frequent at most, found by a sketch of so many counters.
MOST_HOT, TRACKED = 128, 4096
#: A code is frequent from so many parts of a task's mean rows on, and is dealt out in such parts.
PARTS_OF_A_TASK = 8


@dataclass(frozen=True)
class HotCodes:
    """Frequent codes of a column, and in how many parts each is dealt out; without code, too."""

    parts: dict[str | int, int]
    parts_of_none: int


def hot_codes(rows: DataFrame, keys: list[str], tasks: int) -> dict[str, HotCodes]:
    """The frequent codes of several columns, in one pass that reads only these. The sketch
    counts a code too high by a small share of all rows at most, never too low by more, so
    a code that it misses is none that a task would notice."""
    seen = rows.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(key).isNull()).alias(f"_none_{key}") for key in keys),
        *(
            F.call_function("approx_top_k", F.col(key), F.lit(MOST_HOT), F.lit(TRACKED)).alias(key)
            for key in keys
        ),
    ).first()
    one = max(1, seen["_rows"] // (tasks * PARTS_OF_A_TASK))
    return {
        key: HotCodes(
            {
                item["item"]: -(-item["count"] // one)
                for item in seen[key]
                if item["item"] is not None and item["count"] > one
            },
            max(1, -(-seen[f"_none_{key}"] // one)),
        )
        for key in keys
    }


def dealt_lookup_join(
    rows: DataFrame, lookup: DataFrame, row_key: str, lookup_key: str, hot: HotCodes
) -> DataFrame:
    """The left join of lookup_join for a large lookup, with frequent codes dealt out: their rows
    by a hash of all columns, and only their lookup rows repeated, once for each part. Tasks
    are then even also without adaptive execution."""
    spark = rows.sparkSession
    part, parts = "_part", "_parts"
    kind = rows.schema[row_key].dataType.simpleString()
    table = spark.createDataFrame(list(hot.parts.items()), f"_code {kind}, {parts} int")
    frequent = F.broadcast(table)  # MOST_HOT rows at most
    of_row = F.when(F.col(row_key).isNull(), hot.parts_of_none).otherwise(F.coalesce(parts, F.lit(1)))
    dealt = rows.join(frequent, F.col(row_key) == F.col("_code"), "left").withColumn(
        part, F.pmod(F.xxhash64(*rows.columns), of_row)
    )
    repeated = (
        lookup.join(frequent, F.col(lookup_key) == F.col("_code"), "left")
        .withColumn("_of", F.explode(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1)))
        .withColumn("_of", F.col("_of").cast("long"))
        .select(*lookup.columns, "_of")
    )
    # Rows without code match nothing, but are spread by their parts in the same way.
    same = (F.col(row_key) == F.col(lookup_key)) & (F.col(part) == F.col("_of"))
    joined = dealt.select(*rows.columns, part).join(repeated.hint("merge"), same, "left")
    return joined.drop(part, "_of")


def lookup_join(
    rows: DataFrame, lookup: DataFrame, row_key: str, lookup_key: str, small: bool
) -> DataFrame:
    """Left join of `rows` to a lookup with unique keys.

    `small` says that the lookup was measured and fits a broadcast. Otherwise both sides
    are shuffled once by the code and merged: the hint keeps Spark from broadcasting a
    lookup whose files merely compress well. A very frequent code, or no code, is a
    partition of `rows` that adaptive execution splits over several tasks, each with the
    few lookup rows of that partition; nothing else is repeated.
    """
    lookup = F.broadcast(lookup) if small else lookup.hint("merge")
    return rows.join(lookup, F.col(row_key) == F.col(lookup_key), "left")
