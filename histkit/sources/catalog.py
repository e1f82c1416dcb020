"""Named raw tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Source:
    database: str
    schema: str
    tables: tuple[str, ...]


# The raw tables by source.
SOURCES = {
    "feedback_raw": Source(
        "HR_RAW",
        "feedback",
        (
            "ckapp_dimension_history",
            "ckapp_function_history",
            "ckapp_level_history",
            "ckapp_organization_history",
            "ckapp_role_history",
            "ckapp_rubric_history",
            "feedback_dimensionvaluefeedbackitem_history",
            "feedback_employeeptlsnapshot_history",
            "feedback_round_history",
            "feedback_integerfeedbackitem_history",
            "form_builder_form_history",
            "feedback_feedback_history",
            "feedback_calibration_history",
            "workdayprofile_history",
            "feedback_employeeptlinfo_history",
        ),
    ),
    "icims_raw": Source(
        "HR_RAW_QA",
        "icims",
        (
            "talentpool",
            "connectevent",
            "person",
            "room",
            "connecteventworkflow",
            "connecteventworkflowsource",
            "company",
            "sourceworkflow",
            "submittal",
        ),
    ),
    "workday_raw": Source(
        "HR_RAW",
        "workday",
        (
            "workday_locations",
            "workday_locations_hierarchy",
            "workday_cost_centers",
            "workday_supervisory_organizations",
            "workday_companies",
            "workday_custom_organizations",
            "workday_job_profiles",
            "workday_suppliers",
            "workday_transactions",
        ),
    ),
}


def read_source(
    spark: SparkSession,
    source: str,
    table: str,
    root: str | None = None,
    tables: Mapping[str, str] | None = None,
    database: str | None = None,
) -> DataFrame:
    """The raw table ``source.table``.

    ``tables`` maps a table name to where it really is: a path, or the name of
    a catalog table. Otherwise the table is Parquet under
    ``<root>/<schema>/<table>`` or, without a root, the catalog table
    ``<database>.<schema>.<table>``; ``database`` replaces the declared
    one, as between test and live data.
    """
    declared = SOURCES[source]
    if table not in declared.tables:
        raise KeyError(f"{source} has no table {table}")
    place = (tables or {}).get(table)
    if place is not None:
        return spark.read.parquet(place) if "/" in place else spark.table(place)
    if root is not None:
        return spark.read.parquet(f"{root.rstrip('/')}/{declared.schema}/{table}")
    return spark.table(f"{database or declared.database}.{declared.schema}.{table}")
