"""Declared tables: how Bronze text becomes typed Silver columns.

A table is described once; reading, cleaning, registering and streaming all
work from the description.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT, WHOLE, REAL, MOMENT = "text", "whole", "real", "moment"

SILVER_TYPES = {
    TEXT: T.StringType(),
    WHOLE: T.IntegerType(),
    REAL: T.DoubleType(),
    MOMENT: T.TimestampType(),
}

# Fixed value: the text form of every timestamp in the Bronze files.
TS_PATTERN = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class Below:
    """An upper bound that does not belong to its band itself."""

    bound: float


@dataclass(frozen=True)
class Table:
    """``columns`` maps a column to its kind, in file order.

    ``required`` columns must not be null in Silver; ``day_of`` maps a derived
    date column to the timestamp it is taken from; ``partition_by`` names the
    Silver partition columns; ``time`` is the event time of a stream. ``multiline``
    tables may hold line breaks in quoted text; their files are not split for reading.
    """

    name: str
    columns: dict[str, str]
    required: tuple[str, ...] = ()
    day_of: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    time: str | None = None
    multiline: bool = False

    @property
    def bronze_schema(self) -> T.StructType:
        """All text: nothing is lost or guessed before Silver casts it."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def silver_schema(self) -> T.StructType:
        fields = [T.StructField(c, SILVER_TYPES[kind]) for c, kind in self.columns.items()]
        fields += [T.StructField(c, T.DateType()) for c in self.day_of]
        return T.StructType(fields)


# Column names and types of the three hospital tables.
PATIENTS = Table(
    name="patients",
    columns={
        "patient_id": TEXT,
        "age": WHOLE,
        "gender": TEXT,
        "department": TEXT,
        "admission_type": TEXT,
        "diagnosis": TEXT,
        "admission_ts": MOMENT,
        "discharge_ts": MOMENT,
        "length_of_stay": WHOLE,
        "readmitted_30d": WHOLE,
    },
    required=("patient_id",),
    time="admission_ts",
)

VITALS = Table(
    name="vitals",
    columns={
        "device_id": TEXT,
        "patient_id": TEXT,
        "department": TEXT,
        "reading_ts": MOMENT,
        "heart_rate": REAL,
        "spo2": REAL,
        "temperature": REAL,
        "bp_systolic": WHOLE,
        "bp_diastolic": WHOLE,
    },
    required=("patient_id",),
    time="reading_ts",
)

OPERATIONS = Table(
    name="operations",
    columns={
        "snapshot_ts": MOMENT,
        "department": TEXT,
        "beds_total": WHOLE,
        "beds_occupied": WHOLE,
        "occupancy_rate": REAL,
        "patients_waiting": WHOLE,
        "avg_wait_minutes": WHOLE,
    },
    day_of={"snapshot_date": "snapshot_ts"},
    partition_by=("department",),
    time="snapshot_ts",
)

HOSPITAL = {t.name: t for t in (PATIENTS, VITALS, OPERATIONS)}

# Upper bounds and labels of the age groups. The first group ends before
# its bound, the next two with theirs. The last label takes everything above the last
# bound, and missing ages.
AGE_BANDS = ((Below(18), "0-17"), (40, "18-40"), (65, "41-65"))
AGE_REST = "65+"
