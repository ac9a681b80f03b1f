"""Port, destination and origin decoding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_engine.operators.joins import HotCodes, dealt_lookup_join, hot_codes, lookup_join
from arrivals_engine.operators.quality import QualityError, measure_lookups

# Fixed value: stands for a code without an entry, and for an empty entry.
OTHER = "Other"

MAX_BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Lookup:
    frame: DataFrame
    small: bool


@dataclass(frozen=True)
class Lookups:
    ports: Lookup
    destinations: Lookup
    origins: Lookup


def int_origin_codes(origins: DataFrame) -> DataFrame:
    """Origin codes come as text; one that is no number matches nothing."""
    return origins.withColumn("origin_code", F.col("origin_code").try_cast("int"))


def checked_lookups(
    ports: DataFrame,
    destinations: DataFrame,
    origins: DataFrame,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> Lookups:
    """Measures the three lookups in one job. A repeated key would multiply visits
    after they were made distinct, so it is refused here."""
    keyed = {
        "ports": (ports, "port_code"),
        "destinations": (destinations, "dest_state_code"),
        "origins": (int_origin_codes(origins), "origin_code"),
    }
    keyed = {name: (df.dropna(subset=[key]), key) for name, (df, key) in keyed.items()}
    stats = measure_lookups(keyed)
    repeated = {name: s.surplus for name, s in stats.items() if s.surplus}
    if repeated:
        raise QualityError(f"repeated lookup keys: {repeated}")
    return Lookups(
        **{
            name: Lookup(df, stats[name].bytes <= max_broadcast_bytes)
            for name, (df, _) in keyed.items()
        }
    )


Hot = dict[str, HotCodes]


def hot_codes_of(typed: DataFrame, lookups: Lookups) -> Hot:
    """The frequent codes of those columns whose lookups are too large to broadcast."""
    of = {"i94port": lookups.ports, "i94addr": lookups.destinations, "i94cit": lookups.origins}
    keys = [key for key, lookup in of.items() if not lookup.small]
    tasks = int(typed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return hot_codes(typed, keys, tasks) if keys else {}


def _decoded(rows: DataFrame, lookup: Lookup, key: str, code: str, hot: Hot | None) -> DataFrame:
    if hot and key in hot and not lookup.small:
        return dealt_lookup_join(rows, lookup.frame, key, code, hot[key])
    return lookup_join(rows, lookup.frame, key, code, lookup.small)


def decode_port(rows: DataFrame, ports: Lookup, hot: Hot | None = None) -> DataFrame:
    return _decoded(rows, ports, "i94port", "port_code", hot).drop("port_code")


def decode_destination(rows: DataFrame, destinations: Lookup, hot: Hot | None = None) -> DataFrame:
    """A known code comes back as dest_state_code, an unknown one as null."""
    return _decoded(rows, destinations, "i94addr", "dest_state_code", hot)


def decode_origin(rows: DataFrame, origins: Lookup, hot: Hot | None = None) -> DataFrame:
    return _decoded(rows, origins, "i94cit", "origin_code", hot).drop("origin_code")


def fill_misses(rows: DataFrame) -> DataFrame:
    """'Other' in those decoded columns that the frame has."""
    decoded = {
        "port_city",
        "port_state_code",
        "dest_state_code",
        "dest_state_name",
        "origin_country",
    }
    return rows.fillna(OTHER, subset=[c for c in rows.columns if c in decoded])


def decode(rows: DataFrame, lookups: Lookups, hot: Hot | None = None) -> DataFrame:
    """With `hot`, the frequent codes of rows, these are dealt out over tasks where the lookup is
    too large to broadcast; without, adaptive execution splits them."""
    rows = decode_port(rows, lookups.ports, hot)
    rows = decode_destination(rows, lookups.destinations, hot)
    rows = decode_origin(rows, lookups.origins, hot)
    return fill_misses(rows)
