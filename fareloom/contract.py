"""The data contract: column names and types, fleets, value bounds, layers.

Everything the operators treat as a rule is data here, so that another fleet,
another bound or another month needs no change of code.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Canonical trip columns. The public trip files use these names
# and types, and the SQL written over the layers relies on them.
VENDOR = "VendorID"
PASSENGERS = "passenger_count"
AMOUNT = "total_amount"
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
DISTANCE = "trip_distance"

REQUIRED: dict[str, str] = {
    VENDOR: "bigint",
    PASSENGERS: "double",
    AMOUNT: "double",
    PICKUP: "timestamp_ntz",
    DROPOFF: "timestamp_ntz",
}
OPTIONAL: dict[str, str] = {
    DISTANCE: "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
}
FLEET = "taxi_type"
PROVENANCE: dict[str, str] = {
    FLEET: "string",
    "year_month": "string",
    "source_file": "string",
    "ingestion_timestamp": "timestamp",
}
CONTRACT: dict[str, str] = {**REQUIRED, **OPTIONAL, **PROVENANCE}

# Derived columns added on the way up.
DURATION = "trip_duration_minutes"
YEAR, MONTH, HOUR, WEEKDAY = "pickup_year", "pickup_month", "pickup_hour", "pickup_dayofweek"

# Effective key of the hourly rollup. The period of day is a function of the
# hour, and weekday name and weekend flag are functions of the weekday.
CELL_KEY = (FLEET, YEAR, MONTH, HOUR, WEEKDAY)
PARTITIONING = (FLEET, YEAR, MONTH)


@dataclass(frozen=True)
class Fleet:
    """One source of trips and how its own column names map to ours."""

    name: str
    renames: Mapping[str, str] = field(default_factory=dict)

    def native(self, columns) -> list[str]:
        """Canonical column names in this fleet's own vocabulary."""
        own = {canonical: native for native, canonical in self.renames.items()}
        return [own.get(name, name) for name in columns]


# Fleet names and the prefix their timestamp columns carry.
YELLOW = Fleet("yellow")
GREEN = Fleet("green", {"lpep_pickup_datetime": PICKUP, "lpep_dropoff_datetime": DROPOFF})
FLEETS: dict[str, Fleet] = {fleet.name: fleet for fleet in (YELLOW, GREEN)}


@dataclass(frozen=True)
class Bound:
    low: float
    high: float


# Declared ranges of the numeric columns, both ends included.
BOUNDS: dict[str, Bound] = {
    PASSENGERS: Bound(0, 10),
    AMOUNT: Bound(0, 1000),
    DISTANCE: Bound(0, 100),
}
DURATION_BOUND = Bound(1, 1440)  # minutes

# Layer names and the table each one lives in.
LAYER_TABLES: dict[str, str] = {
    "raw": "raw_trips",
    "bronze": "bronze_trips",
    "silver": "silver_trips",
    "gold": "gold_trips",
}

# Tables beside the layers: zones of raw files, rows that a layer rejects, and
# sketches of its columns.
SIDE_TABLES: dict[str, str] = {
    "raw_zones": "raw_zones",
    "bronze_rejects": "bronze_rejected_trips",
    "silver_rejects": "silver_rejected_trips",
    "silver_sketches": "silver_sketches",
}
