"""Literal code tables of the ticket domain."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from opsmart.contracts import silver_schema
from opsmart.sources import lake

# Codes and labels.
STATUS = {
    1: "New",
    2: "In progress (Assigned)",
    3: "In progress (Planned)",
    4: "Pending",
    5: "Solved",
    6: "Closed",
}
PRIORITY = {2: "Low", 3: "Medium", 4: "High", 5: "Very high", 6: "Major"}
TYPE = {1: "Incident", 2: "Request"}
CATEGORY = {
    0: None,
    1: "IT and Support",
    2: "Maintenance",
    3: "Security",
    4: "Purchasing",
    5: "Event",
    6: "Finishing & decoration",
    7: "Room rental",
    8: "Electricity",
    9: "Inventory",
    10: "Daily preventive check",
    11: "Client sales",
    12: "Preventive",
    13: "Hygiene",
    14: "Equipment rental",
    15: "Plumbing",
    16: "Fluids",
    17: "External event",
    18: "Data analysis",
    19: "External intervention",
}
# {site} is the name of the site that runs the service desk: a setting of each deployment.
LOCATION = {
    0: None,
    1: "Medianet",
    2: "{site}",
    3: "Externe de {site}",
    4: "Saphir Consult",
    6: "9ème - Coworking",
    7: "Cilié",
    8: "Medianet Ennaser",
    9: "Express FM",
    11: "Cochef",
    12: "1er étage",
    13: "Salle Avant Première",
    14: "Salle COSY",
    15: "Salle de Stock",
    16: "9éme étage",
    17: "Grand Terrasse",
    18: "Hors {site}",
    19: "Salle 13",
    20: "Salle Confidentielle",
    21: "Salle 11",
    22: "Salle 12",
    23: "Dépôt-Principale",
    25: "Dépôt-Technique",
    26: "LT",
    27: "Studio",
}
DEFAULT_SITE = "Site"


def location_labels(site: str = DEFAULT_SITE) -> dict[int, str | None]:
    """Location codes with the site's own name filled in."""
    return {code: label and label.format(site=site) for code, label in LOCATION.items()}


def code_tables(site: str = DEFAULT_SITE) -> dict[str, dict[int, str | None]]:
    """Table name -> {code: label}."""
    return {
        "ticket_status": STATUS,
        "ticket_priority": PRIORITY,
        "ticket_type": TYPE,
        "ticket_category": CATEGORY,
        "ticket_location": location_labels(site),
    }


def code_table(spark: SparkSession, table: str, site: str = DEFAULT_SITE) -> DataFrame:
    """One code table; a few dozen rows at most.

    Built from an Arrow table, which Spark keeps as a local relation of the plan: using it starts
    no Python worker.
    """
    schema = silver_schema(table)
    labels = code_tables(site)[table]
    key, label = schema.names
    columns = {
        key: pa.array(labels.keys(), pa.int64()),
        label: pa.array(labels.values(), pa.string()),
    }
    return spark.createDataFrame(pa.table(columns), schema)


def all_code_tables(spark: SparkSession, site: str = DEFAULT_SITE) -> dict[str, DataFrame]:
    """Every code table by name."""
    return {name: code_table(spark, name, site) for name in code_tables(site)}


def write_code_tables(spark: SparkSession, silver_root: str, site: str = DEFAULT_SITE) -> None:
    """Store the code tables next to the other silver tables."""
    for name, df in all_code_tables(spark, site).items():
        lake.replace_snapshot(df.coalesce(1), f"{silver_root}/{name}")
