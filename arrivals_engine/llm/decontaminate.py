"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

Texts are words without ASCII white space, A-Z lower-cased. A document is contaminated if, in
some stretch of ``window`` words of an item (all of it, if it is shorter), at least ``percent``
of the words agree with the document's at one distance. A seed is a hash of the words that a
fixed mask selects, as ``10111`` of five words all but the second; words that it ignores may
differ. For each length of stretch the mask is the one with the most selected words that, by
trying all patterns of as many differing words as are allowed, stands somewhere on agreeing
words only; so no stretch that agrees enough is missed. Seeds of items and documents are
joined. A hit names a document, an item and the distance between their seeds; on that diagonal
the words are compared one by one.

Items of equal words are one item, named by its smallest id. The side of the benchmark is
broadcast only if its counted seeds are at most ``broadcast_seeds``; beyond that the join
shuffles and merges. Seeds of documents are shuffled only in that case.

Defined results: items without a word or without id are not searched for. Null and empty texts
match nothing. Rows with the same doc_id are one document;
without doc_id, rows of the same text are. Other columns are kept, whatever their names. The
words of a very long text are one row's array; tables without rows give none.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals_engine.llm.common import SPACE, free_name, lower_ascii, row_identity, strip_space

#: The fewest words of an item that is searched for.
SPAN = 1
#: With more patterns than this to try, a mask selects words in a row, which always does.
MOST_PATTERNS = 200_000
_HIT = "array<struct<item_id:bigint,shift:int,words:array<string>>>"


def words(text: Column) -> Column:
    return F.split(strip_space(lower_ascii(F.coalesce(text, F.lit("")))), SPACE)


def _stands(mask: int, length: int, patterns: list[int]) -> bool:
    """Whether the mask stands on agreeing words only somewhere, whatever pattern differs."""
    placed = [mask << k for k in range(length - mask.bit_length() + 1)]
    return all(any(not at & differ for at in placed) for differ in patterns)


@lru_cache(maxsize=None)
def mask_for(length: int, percent: int) -> str:
    """The mask for stretches of so many words of which so many percent agree at least."""
    differ = length - -(-length * percent // 100)
    run = -(-(length - differ) // (differ + 1))  # so many agreeing words stand together somewhere
    if not differ or comb(length, differ) > MOST_PATTERNS:
        return "1" * run
    patterns = [sum(1 << k for k in chosen) for chosen in combinations(range(length), differ)]
    for weight in range(run + 2, max(run, 2) - 1, -1):
        for span in range(weight + 1, min(length - differ + 1, weight + 6) + 1):
            for inner in combinations(range(1, span - 1), weight - 2):
                mask = 1 | 1 << (span - 1) | sum(1 << k for k in inner)
                if _stands(mask, length, patterns):
                    return f"{mask:b}"
    return "1" * run


def _mask_of(n: Column, window: int, percent: int) -> Column:
    masks = F.array(*(F.lit(mask_for(k, percent)) for k in range(1, window + 1)))
    return F.get(masks, F.least(n, F.lit(window)) - 1)


def _mask_seeds(hashes: Column, mask: str) -> Column:
    """A hash of the selected words for each place of the mask, in order; none if there are fewer
    words than it spans."""
    starts = F.sequence(F.lit(0), F.size(hashes) - len(mask))
    selected = [k for k, bit in enumerate(mask) if bit == "1"]
    seeds = F.transform(
        starts, lambda at: F.xxhash64(F.lit(mask), *(F.get(hashes, at + k) for k in selected))
    )
    return F.when(F.size(hashes) >= len(mask), seeds)


def seeds(rows: DataFrame, name: str, masks: list[str]) -> DataFrame:
    """(name, seed, at): the seeds of the words of rows (name, words), with their place. With a
    column mask, a row has those of that mask only."""
    own = [F.col("mask")] if "mask" in rows.columns else []
    hashed = rows.select(name, *own, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    parts = [_mask_seeds(F.col("h"), mask) for mask in masks]
    if own:
        parts = [F.when(F.col("mask") == mask, part) for mask, part in zip(masks, parts, strict=True)]
    # An inner explode would have the optimizer compute the array once more, in a filter.
    none = F.array().cast("array<bigint>")
    each = F.array(*(F.coalesce(part, none) for part in parts)) if parts else F.array(none)
    return (
        hashed.select(name, F.explode_outer(each).alias("seeds"))
        .select(name, F.posexplode_outer("seeds").alias("at", "seed"))
        .where(F.col("seed").isNotNull())
        .select(name, "seed", "at")
    )


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, words) of different items that have words."""
    return (
        benchmark.select(F.col("item_id").cast("long"), words(F.col("text")).alias("words"))
        .where(F.col("item_id").isNotNull() & (F.size("words") >= SPAN) & (F.col("words")[0] != ""))
        .groupBy("words")
        .agg(F.min("item_id").alias("item_id"))
    )


def hits(
    docs: DataFrame, items: DataFrame, broadcast_seeds: int, window: int, percent: int
) -> DataFrame:
    """(doc, hits): the items, with their words, and shifts at which seeds of the doc agree."""
    sized = items.withColumn("mask", _mask_of(F.size("words"), window, percent))
    # A row for each mask, at most window.
    n_seeds = F.sum(F.size("words") - F.length("mask") + 1)
    counted = sized.groupBy("mask").agg(n_seeds.alias("n")).collect()
    masks = sorted(r["mask"] for r in counted)
    small = sum(r["n"] for r in counted) <= broadcast_seeds
    wanted = seeds(sized, "item_id", masks)
    ours = docs.select(
        row_identity(F.col("doc_id"), F.col("text")).alias("doc"), words(F.col("text")).alias("words")
    )
    found = (
        seeds(ours, "doc", masks)
        .withColumnRenamed("at", "doc_at")
        .join(F.broadcast(wanted) if small else wanted.hint("merge"), "seed")
        .select("doc", "item_id", (F.col("doc_at") - F.col("at")).cast("int").alias("shift"))
        .distinct()
    )
    return (
        found.join(items, "item_id")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("item_id", "shift", "words")).cast(_HIT).alias("hits"))
    )


def _agreeing(mine: Column, hit: Column, window: int) -> tuple[Column, Column]:
    """The most agreeing words in a stretch of the item, and the length of the stretch."""
    size = F.size(hit["words"])
    stretch = F.least(size, F.lit(window))
    same = F.transform(
        hit["words"],
        lambda word, k: F.when(
            (hit["shift"] + k >= 0)
            & (hit["shift"] + k < F.size(mine))
            & (F.get(mine, hit["shift"] + k) == word),
            1,
        ).otherwise(0),
    )
    sums = F.transform(
        F.sequence(F.lit(1), size - stretch + 1),
        lambda start: F.aggregate(F.slice(same, start, stretch), F.lit(0), lambda a, b: a + b),
    )
    return F.array_max(sums), stretch


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 20,
    percent: int = 80,
    broadcast_seeds: int = 1_000_000,
    into: str = "leaks",
) -> DataFrame:
    """docs and an array column ``into`` of (item_id, agree, stretch), empty for clean rows."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be over 0 and at most 100, not {percent}")
    found = hits(docs, items_of(benchmark), broadcast_seeds, window, percent)
    doc, hit_list, name, row = (
        free_name(docs, f"_leak_{k}") for k in ("doc", "hits", "words", "row")
    )
    found = found.select(F.col("doc").alias(doc), F.col("hits").alias(hit_list))
    mine = F.when(F.col(hit_list).isNotNull(), words(F.col("text")))

    def judged(hit: Column) -> Column:
        agree, stretch = _agreeing(F.col(name), hit, window)
        return F.struct(
            hit["item_id"].alias("item_id"), agree.alias("agree"), stretch.alias("stretch")
        )

    checked = F.transform(F.coalesce(hit_list, F.array().cast(_HIT)), judged)
    leaks = F.filter(checked, lambda x: x["agree"] * 100 >= x["stretch"] * percent)
    return (
        docs.withColumn(doc, row_identity(F.col("doc_id"), F.col("text")))
        .join(found, doc, "left")
        .withColumn(name, mine)
        # The number keeps later filters from being pushed below, where they would compute
        # the words once for each word of an item.
        .withColumns({into: leaks, row: F.monotonically_increasing_id()})
        .where(F.col(row) >= 0)
        .drop(doc, hit_list, name, row)
    )


def leaks(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """A row per contaminated document and item: doc_id, item_id, how many words agree, of how
    many. Documents without a row are clean."""
    found = with_leaks(docs.select("doc_id", "text"), benchmark, into="leaks", **how)
    return (
        found.where(F.size("leaks") > 0)
        .select("doc_id", F.explode("leaks").alias("leak"))
        .groupBy("doc_id", F.col("leak")["item_id"].alias("item_id"))
        .agg(
            F.max(F.struct(F.col("leak")["agree"], F.col("leak")["stretch"])).alias("best"),
        )
        .select(
            "doc_id", "item_id", F.col("best.agree").alias("agree"), F.col("best.stretch").alias("stretch")
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of docs without leaks."""
    into = free_name(docs, "_leaks")
    return with_leaks(docs, benchmark, into=into, **how).where(F.size(into) == 0).drop(into)
