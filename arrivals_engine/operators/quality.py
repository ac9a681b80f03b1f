"""Row-count, unique-key, required-column and fit checks, and the gate on them."""

from __future__ import annotations

from contextlib import suppress
from dataclasses import dataclass
from functools import reduce
from threading import Thread

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from arrivals_engine import schemas
from arrivals_engine.functions.dates import month_of
from arrivals_engine.operators.clean import typed_arrival


PUBLISH_CHECKS = ("row_count", "unique_key", "required", "date_range")
LAST_YEAR = 9999
# "fit" also counts values too long or too large for their column. Staged visits
# are held to the column lengths when written, so they need no second look.
ALL_CHECKS = PUBLISH_CHECKS + ("fit",)
#: Keys of a batch beyond so many are merged with the published ones, never broadcast.
MOST_BROADCAST_KEYS = 100_000


class QualityError(Exception):
    """A batch that must not be published."""


# ---- keys -----------------------------------------------------------------


def duplicate_keys(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Every repeated key with its number of rows. Grouped by the key columns
    themselves: glued text would let ('1', '23') collide with ('12', '3')."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def surplus_rows(
    rows: DataFrame, key: tuple[str, ...], name: str = "surplus", count_nulls: bool = True
) -> DataFrame:
    """One row: how many rows there are beyond one per key. With
    count_nulls=False rows with a null key part are left out, which is a count of
    the key minus a count of the distinct keys."""
    if not count_nulls:
        rows = rows.dropna(subset=list(key))
    per_key = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias(name))


# ---- table reports --------------------------------------------------------


def _does_not_fit(column: schemas.Column) -> Column | None:
    value = F.col(column.name)
    if column.width:
        return F.char_length(value) > column.width
    if column.is_decimal:
        return value.isNotNull() & value.try_cast(column.sql_type).isNull()
    return None


def _key_text(key: tuple[str, ...]) -> Column:
    return F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in key))


def _in_key_order(key: tuple[str, ...]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in key]


def _first_keys(
    per_key: DataFrame, key: tuple[str, ...], bad: dict[tuple[str, str], Column], sample: int
) -> DataFrame:
    """(check_name, subject, keys): the smallest keys of each check that is not passed. Ranks
    are limited before the shuffle, so it moves as many rows per task and check at most."""
    broken = F.filter(
        F.array(
            *(
                F.when(is_bad, F.struct(F.lit(check).alias("check_name"), F.lit(name).alias("subject")))
                for (check, name), is_bad in bad.items()
            )
        ),
        lambda x: x.isNotNull(),
    )
    rank = F.row_number().over(Window.partitionBy("_check").orderBy(*_in_key_order(key)))
    first = (
        per_key.select(*key, F.explode(broken).alias("_check"))
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= sample)
    )
    ranked = F.array_sort(F.collect_list(F.struct("_rank", _key_text(key).alias("text"))))
    return first.groupBy("_check").agg(ranked.alias("ranked")).select(
        "_check.*", F.col("ranked.text").alias("keys")
    )


def table_report(
    rows: DataFrame,
    table: schemas.Table,
    checks: tuple[str, ...] = PUBLISH_CHECKS,
    sample: int = 0,
) -> DataFrame:
    """One row per check of a table: check_name, table_name, subject, value, passed. With
    `sample`, also keys: so many of the smallest keys whose rows are at fault, as text.

    All checks share one scan. For the key check rows are counted per key first,
    partly before the shuffle so that a very frequent key is no burden, and the
    other counts and the sample ride along; without them nothing is shuffled but the totals.
    """
    problems: dict[tuple[str, str], Column] = {}
    if "required" in checks:
        problems |= {("required", name): F.col(name).isNull() for name in table.required}
    if "fit" in checks:
        for column in table.columns:
            bad = _does_not_fit(column)
            if bad is not None:
                problems["fit", column.name] = bad
    if "date_range" in checks:
        for column in table.columns:
            if column.sql_type == "DATE":
                year = F.year(column.name)
                problems["date_range", column.name] = (year < 1) | (year > LAST_YEAR)

    counted = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(bad).alias(f"_{check}_{name}") for (check, name), bad in problems.items()
    ]
    by_key = "unique_key" in checks or (sample and table.key)
    if by_key:
        per_key = rows.groupBy(*table.key).agg(*counted)
        summed = {name: F.col(name) for name in per_key.columns if name not in table.key}
        summed["_surplus"] = F.col("_rows") - 1
        totals = per_key.agg(
            *(
                F.coalesce(F.sum(value), F.lit(0)).cast("long").alias(name)
                for name, value in summed.items()
            )
        )
    else:
        totals = rows.agg(*counted)

    def line(check: str, subject: str, value: str, passed: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check_name"),
            F.lit(table.name).alias("table_name"),
            F.lit(subject).alias("subject"),
            F.col(value).alias("value"),
            passed.alias("passed"),
        )

    lines = []
    if "row_count" in checks:
        lines.append(line("row_count", "", "_rows", F.col("_rows") > 0))
    if "unique_key" in checks:
        lines.append(
            line("unique_key", ",".join(table.key), "_surplus", F.col("_surplus") == 0)
        )
    for check, name in problems:
        value = f"_{check}_{name}"
        lines.append(line(check, name, value, F.col(value) == 0))
    if not lines:  # no column that the checks are about
        report = totals.select(F.inline(F.array(line("", "", "_rows", F.lit(True))))).limit(0)
    else:
        report = totals.select(F.inline(F.array(*lines)))
    if not sample:
        return report
    bad = {(check, name): F.col(f"_{check}_{name}") > 0 for check, name in problems}
    if "unique_key" in checks:
        bad["unique_key", ",".join(table.key)] = F.col("_rows") > 1
    none = F.array().cast("array<string>")
    if not by_key or not bad:
        return report.withColumn("keys", none)
    found = _first_keys(per_key, table.key, bad, sample)
    return report.join(found, ["check_name", "subject"], "left").select(
        *report.columns, F.coalesce("keys", none).alias("keys")
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def batch_report(
    tables: list[tuple[DataFrame, schemas.Table]],
    checks: tuple[str, ...] = PUBLISH_CHECKS,
    sample: int = 0,
) -> DataFrame:
    return union_all([table_report(rows, table, checks, sample) for rows, table in tables])


def gate_batch(
    tables: list[tuple[DataFrame, schemas.Table]],
    checks: tuple[str, ...] = PUBLISH_CHECKS,
    sample: int = 5,
) -> None:
    """The gate on a batch's report. Keys are looked for only in tables that did not pass."""
    failed = batch_report(tables, checks).filter(~F.col("passed")).select("table_name")
    names = {row[0] for row in failed.collect()}
    if names:
        gate(batch_report([(r, t) for r, t in tables if t.name in names], checks, sample))


@dataclass(frozen=True)
class HeldMonths:
    """How many rows a batch has, and its months, each with a month of arrival of its rows."""

    n_rows: int
    pairs: frozenset[tuple[int | None, int | None]]

    @property
    def own(self) -> list[int]:
        return sorted({month for month, _ in self.pairs if month is not None})

    @property
    def arrival(self) -> list[int]:
        return sorted({month for _, month in self.pairs if month is not None})


def held_months(rows: DataFrame) -> HeldMonths:
    """One job, which gathers no more pairs than there are partitions of the key index."""
    month = month_of(F.col("arrival_date")).alias("arrival_month")
    held = rows.groupBy("year_month", month).agg(F.count(F.lit(1)).alias("n")).collect()
    return HeldMonths(
        sum(r["n"] for r in held), frozenset((r["year_month"], r["arrival_month"]) for r in held)
    )


def collision_report(
    rows: DataFrame,
    known: DataFrame,
    table: schemas.Table,
    other_months: bool = False,
    sample: int = 0,
    held: HeldMonths | None = None,
) -> DataFrame:
    """One report row: keys of a batch that the published table already has, with
    `other_months` in months that the batch does not hold.

    known is the key index, or any rows with the key. Of the index only partitions with the
    batch's months of arrival are read, and with `other_months` not those of its own months; a missing day is 1960-01-01, so
    the month of that day is read too if the batch has such rows. Of a batch, these months
    are gathered, of which there are no more than the calendar has, and its rows counted, unless
    they are given as `held`: Spark guesses the size of a few columns from compressed files, and
    would broadcast many millions of keys.
    """
    key = list(table.key)
    own_keys = rows.select(*key)
    if "arrival_month" not in known.columns:
        own_keys = own_keys.hint("merge")
    else:
        held = held or held_months(rows)
        known = known.filter(F.col("arrival_month").isin(held.arrival) & F.col(f"in_{table.name}"))
        if other_months:
            known = known.filter(~F.col("year_month").isin(held.own))
        if held.n_rows > MOST_BROADCAST_KEYS:
            own_keys = own_keys.hint("merge")
    hits = known.select(*key).join(own_keys, key, "left_semi").distinct()
    counted = hits.agg(F.count(F.lit(1)).alias("value"))
    report = counted.select(
        F.lit("new_key").alias("check_name"),
        F.lit(table.name).alias("table_name"),
        F.lit(",".join(key)).alias("subject"),
        "value",
        (F.col("value") == 0).alias("passed"),
    )
    if not sample:
        return report
    first = hits.orderBy(*_in_key_order(table.key)).limit(sample)
    texts = first.agg(F.array_sort(F.collect_list(F.struct(*key, _key_text(table.key).alias("text")))).alias("k"))
    keys = texts.select(F.lit("new_key").alias("check_name"), F.col("k.text").alias("keys"))
    return report.join(keys, "check_name")


def _rejected() -> dict[str, Column]:
    """Per number column of raw arrivals how many values its type cannot hold."""
    return {
        name: F.count_if(F.col(name).isNotNull() & typed_arrival(name).isNull())
        for name, raw, typed in schemas.ARRIVAL_COLUMNS
        if raw != typed
    }


def rejected_report(raw: DataFrame, max_rejected: int | None = None) -> DataFrame:
    """One report row per number column of raw arrivals: how many values are there that its
    type cannot hold, and so become missing. With `max_rejected`, a column with more fails."""
    rejected = _rejected()
    counts = raw.agg(*(count.alias(n) for n, count in rejected.items()))
    lines = [
        F.struct(
            F.lit("rejected").alias("check_name"),
            F.lit("arrivals").alias("table_name"),
            F.lit(n).alias("subject"),
            F.col(n).alias("value"),
            (F.lit(max_rejected is None) | (F.col(n) <= F.lit(max_rejected or 0))).alias("passed"),
        )
        for n in rejected
    ]
    return counts.select(F.inline(F.array(*lines)))


@dataclass(frozen=True)
class LoadCounts:
    """What became of the records of one load. Rejected values are missing in the rows that are
    kept; rows without an id, and whole-row copies of others, are not kept."""

    read: int
    without_id: int
    copies: int
    staged: int
    rejected: dict[str, int]

    def lines(self) -> list[tuple[str, int]]:
        """What is counted, and how often it was met."""
        rejected = [(f"rejected {name}", n) for name, n in self.rejected.items()]
        return [
            ("read", self.read),
            ("without_id", self.without_id),
            ("copies", self.copies),
            ("staged", self.staged),
            *rejected,
        ]


def _load_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("read"),
        F.count_if(typed_arrival("admnum").isNull()).alias("without_id"),
        *(count.alias(f"rejected_{name}") for name, count in _rejected().items()),
    ]


class LoadWatch:
    """Counts raw records and staged rows while the load runs, without a pass of its own.

    Work that a lost executor makes Spark repeat may be counted twice, so a limit that these
    counts break is checked on the records themselves before anything is refused.
    """

    def __init__(self):
        self._raw, self._rows = Observation(), Observation()

    def raw(self, raw: DataFrame) -> DataFrame:
        self._records = raw
        return raw.observe(self._raw, *_load_columns())

    def rows(self, rows: DataFrame) -> DataFrame:
        self._staged = rows
        return rows.observe(self._rows, F.count(F.lit(1)).alias("staged"))

    def counts(self) -> LoadCounts:
        """To be asked after the rows were written."""
        seen, staged = _observed(self._raw), _observed(self._rows)
        if seen is None or staged is None:
            # Nothing was left of the load, so the counters went with its plan.
            return self.exact()
        return self._of(seen, staged["staged"])

    def exact(self) -> LoadCounts:
        seen = self._records.agg(*_load_columns()).first().asDict()
        return self._of(seen, self._staged.count())

    def _of(self, seen: dict[str, int], staged: int) -> LoadCounts:
        rejected = {name: seen[f"rejected_{name}"] for name in _rejected()}
        copies = max(0, seen["read"] - seen["without_id"] - staged)
        return LoadCounts(seen["read"], seen["without_id"], copies, staged, rejected)


def _observed(observation: Observation, seconds: float = 10.0) -> dict[str, int] | None:
    """The observed metrics, or None if the plan that ran had no place for them any more: get
    then waits for ever, or fails."""
    found: dict[str, int] = {}

    def ask() -> None:
        with suppress(Exception):
            found.update(observation.get)

    thread = Thread(target=ask, daemon=True)
    thread.start()
    thread.join(seconds)
    return found or None


def limit_rejected(watch: LoadWatch, max_rejected: int) -> None:
    """Raises if a column has more rejected values than that."""
    if max(watch.counts().rejected.values()) > max_rejected:
        for name, n in watch.exact().rejected.items():
            if n > max_rejected:
                raise QualityError(f"arrivals: rejected({name}) = {n}")


def gate(report: DataFrame) -> None:
    """Raises if any check failed. The report has a few rows per table."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        lines = []
        for r in failed:
            keys = f", first {'; '.join(r['keys'])}" if "keys" in r and r["keys"] else ""
            lines.append(f"{r.table_name}: {r.check_name}({r.subject}) = {r.value}{keys}")
        raise QualityError("; ".join(lines))


# ---- lookups --------------------------------------------------------------


@dataclass(frozen=True)
class LookupStats:
    bytes: int
    surplus: int


def measure_lookups(keyed: dict[str, tuple[DataFrame, str]]) -> dict[str, LookupStats]:
    """In-memory size and surplus keys of several lookups, in one job that returns
    one row per lookup."""

    def row_bytes(frame: DataFrame) -> Column:
        text = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in frame.columns]
        # 32 for the row and 16 for each field's slot and padding
        return sum(text, F.lit(32 + 16 * len(text))).cast("long")

    per_row = union_all(
        [
            frame.select(
                F.lit(name).alias("name"),
                F.col(key).cast("string").alias("key"),
                row_bytes(frame).alias("bytes"),
            )
            for name, (frame, key) in keyed.items()
        ]
    )
    per_key = per_row.groupBy("name", "key").agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("copies")
    )
    measured = per_key.groupBy("name").agg(
        F.sum("bytes").alias("bytes"), F.sum(F.col("copies") - 1).alias("surplus")
    )
    found = {r["name"]: LookupStats(r["bytes"], r["surplus"]) for r in measured.collect()}
    return {name: found.get(name, LookupStats(0, 0)) for name in keyed}
