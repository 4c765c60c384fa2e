"""The hospital tables: Silver, Gold and the dashboard queries.

``silver`` and ``gold`` are the batch; the functions named after a question are
the dashboard queries and work on any frame with the columns they use.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.columns import band
from strandline.operators.aggregates import avg_of, band_rate, daily_trend, kpi_by_dim, max_of, sum_of
from strandline.operators.clean import clean
from strandline.operators.joins import join_kpi
from strandline.operators.states import Metric, count, from_states, highest, mean, share, total
from strandline.schemas import AGE_BANDS, AGE_REST, HOSPITAL, OPERATIONS, PATIENTS, VITALS, Table
from strandline.session import at_once, build_session, sized_for
from strandline.sources.runs import whole_run
from strandline.sources.zones import read_bronze, read_curated, table_path, write_parquet
from strandline.streaming.gold import kpi_of_parents, read_states, refresh_states, state_day
from strandline.streaming.readings import read_silver_stream


def load_metrics() -> dict[str, Column]:
    return {
        "avg_occupancy_pct": avg_of("occupancy_rate", 1, 100),
        "avg_wait_min": avg_of("avg_wait_minutes", 1),
    }


def department_kpis(operations: DataFrame, ordered: bool = True) -> DataFrame:
    """Occupancy, waiting time and longest queue per department, fullest first."""
    metrics = load_metrics() | {"peak_queue": max_of("patients_waiting")}
    order = "avg_occupancy_pct" if ordered else None
    return kpi_by_dim(operations, ["department"], metrics, order_by=order)


def readmission_by_age(
    patients: DataFrame, by_department: bool = True, ordered: bool = True
) -> DataFrame:
    """Readmission rate per age group, for each department or over all."""
    return band_rate(
        patients,
        ["department"] if by_department else [],
        "age",
        AGE_BANDS,
        AGE_REST,
        "readmitted_30d",
        names=("age_group", "total_patients", "readmissions", "readmit_rate_pct"),
        ordered=ordered,
    )


def vitals_by_admission_type(vitals: DataFrame, patients: DataFrame) -> DataFrame:
    """Mean vital signs per kind of admission, over readings of known patients."""
    measures = {
        "avg_heart_rate": ("heart_rate", 1, 1),
        "avg_spo2": ("spo2", 1, 1),
        "avg_temp_c": ("temperature", 2, 1),
        "avg_systolic_bp": ("bp_systolic", 0, 1),
    }
    return join_kpi(
        vitals,
        patients,
        "patient_id",
        "admission_type",
        measures,
        parent_count="patients",
        order_by="avg_heart_rate",
    )


def load_trend(operations: DataFrame, ts: str = "snapshot_ts", day: str = "day") -> DataFrame:
    """Occupancy, waiting time and patients waiting per day."""
    metrics = load_metrics() | {"total_waiting": sum_of("patients_waiting")}
    return daily_trend(operations, ts, metrics, day)


def silver(spark: SparkSession, bronze_zone: str, silver_zone: str) -> None:
    """Clean every Bronze table and replace its Silver table, all at the same time."""

    def write(table: Table) -> None:
        rows = clean(read_bronze(spark, bronze_zone, table), table)
        write_parquet(rows, table_path(silver_zone, table.name), table.partition_by)

    at_once(spark, write, list(HOSPITAL.values()))


def gold(spark: SparkSession, silver_zone: str, gold_zone: str) -> None:
    """Build the Gold tables from the stored Silver tables.

    Reading Silver back means that cleaning runs once, and that each Gold table
    reads only its columns.
    """
    operations = read_curated(spark, silver_zone, OPERATIONS)
    patients = read_curated(spark, silver_zone, PATIENTS)
    tables = {
        "department_kpis": department_kpis(operations, ordered=False),
        "readmission_by_age": readmission_by_age(patients, ordered=False),
        "daily_trend": load_trend(operations, "snapshot_date", "snapshot_date"),
    }
    at_once(spark, lambda name: write_parquet(tables[name], table_path(gold_zone, name)), list(tables))


def medallion_run(spark: SparkSession, bronze_zone: str, silver_zone: str, gold_zone: str) -> None:
    """Bronze to Silver to Gold. Running it again replaces all six tables, or none if it fails."""
    with sized_for(spark, bronze_zone), whole_run(spark, silver_zone, gold_zone) as (own_silver, own_gold):
        silver(spark, bronze_zone, own_silver)
        gold(spark, own_silver, own_gold)


# --- Gold that follows the streams ---

def load_states() -> dict[str, Metric]:
    return {
        "avg_occupancy_pct": mean("occupancy_rate", 1, 100),
        "avg_wait_min": mean("avg_wait_minutes", 1),
        "peak_queue": highest("patients_waiting"),
        "total_waiting": total("patients_waiting"),
    }


def readmission_states() -> dict[str, Metric]:
    return {
        "total_patients": count(),
        "readmissions": total("readmitted_30d"),
        "readmit_rate_pct": share("readmitted_30d", 1),
    }


def vital_states() -> dict[str, Metric]:
    return {
        "avg_heart_rate": mean("heart_rate", 1),
        "avg_spo2": mean("spo2", 1),
        "avg_temp_c": mean("temperature", 2),
        "avg_systolic_bp": mean("bp_systolic", 0),
    }


def finest_states() -> dict[str, tuple[dict[str, Column | str], dict[str, Metric]]]:
    """Per table the finest dimensions of its states beside the day, and its metrics."""
    ages = band("age", AGE_BANDS, AGE_REST)
    return {
        OPERATIONS.name: ({"department": "department"}, load_states()),
        PATIENTS.name: ({"department": "department", "age_group": ages}, readmission_states()),
        VITALS.name: ({"patient_id": "patient_id"}, vital_states()),
    }


def some(metrics: Mapping[str, Metric], *names: str) -> dict[str, Metric]:
    return {name: metrics[name] for name in names}


def refresh_gold(spark: SparkSession, silver_zone: str, states_zone: str, gold_zone: str) -> dict[str, int]:
    """Bring the four Gold tables up to the streamed Silver tables below ``silver_zone``.

    They equal what ``department_kpis``, ``readmission_by_age``, ``vitals_by_admission_type``
    and ``load_trend`` give over all of Silver. Only days that a batch touched since the last
    refresh are read from Silver; gives the number of these days per table.
    """
    read = {}

    def refresh(name: str) -> None:
        keys, metrics = finest_states()[name]
        path = table_path(states_zone, name)
        read[name] = refresh_states(spark, HOSPITAL[name], table_path(silver_zone, name), path, keys, metrics)

    at_once(spark, refresh, list(HOSPITAL))
    states = {name: read_states(spark, table_path(states_zone, name)) for name in read}
    load = states[OPERATIONS.name]
    patients = read_silver_stream(spark, PATIENTS, table_path(silver_zone, PATIENTS.name))
    tables = {
        "department_kpis": from_states(
            load, ["department"], some(load_states(), "avg_occupancy_pct", "avg_wait_min", "peak_queue")
        ),
        "readmission_by_age": from_states(states[PATIENTS.name], ["department", "age_group"], readmission_states()),
        "vitals_by_admission_type": kpi_of_parents(
            states[VITALS.name], patients, "patient_id", "admission_type", vital_states(), "patients"
        ),
        "daily_trend": from_states(
            load,
            [state_day().alias("snapshot_date")],
            some(load_states(), "avg_occupancy_pct", "avg_wait_min", "total_waiting"),
        ).orderBy(F.asc_nulls_last("snapshot_date")),
    }
    with whole_run(spark, gold_zone) as (own_gold,):
        at_once(spark, lambda name: write_parquet(tables[name], table_path(own_gold, name)), list(tables))
    return read


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Bronze CSV to Silver and Gold Parquet")
    parser.add_argument("--bronze", required=True)
    parser.add_argument("--silver", required=True)
    parser.add_argument("--gold", required=True)
    args = parser.parse_args(argv)
    medallion_run(build_session("strandline-medallion"), args.bronze, args.silver, args.gold)


if __name__ == "__main__":
    main()
