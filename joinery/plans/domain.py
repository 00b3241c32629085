"""The work-item enrichment domain: its key rule and names.

Operators take every name as an argument; this module only holds the values a
user of the original job expects by default."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import with_join_key

# Fixed values (must equal the original job's for equal keys and labels):
#   key parts, in order: data_source, process, subprocess_1, subprocess_2,
#     subprocess_3, subprocess_4, subprocess_5, subprocess_6
#   rows whose raw data_source is exactly "CART" leave out subprocess_4
#   separator "|", key column "JoinKey"
#   activity labels: Center from New_Center, Capacity_Planning_Group from
#     Capacity_Planning_Group, default "Not Defined"
#   hierarchy: JSON field employee_number, snapshot key employeeid, snapshot
#     grouped by employeeid and employeename, latest snap_date as latest_snap_date
#   output names activity_data, employee_hierarchy, output
WORK_ITEM_PARTS = [
    "data_source", "process", "subprocess_1", "subprocess_2",
    "subprocess_3", "subprocess_4", "subprocess_5", "subprocess_6",
]
SHORT_KEY_SOURCE = "CART"
SHORT_KEY_DROPS = "subprocess_4"
KEY_SEP = "|"
KEY_COL = "JoinKey"
ACTIVITY_TAKE = {"Center": "New_Center", "Capacity_Planning_Group": "Capacity_Planning_Group"}
HIERARCHY_FIELD = "employee_number"
HIERARCHY_KEY = "employeeid"
HIERARCHY_GROUP = ["employeeid", "employeename"]
HIERARCHY_TS = "snap_date"
HIERARCHY_OUT = "latest_snap_date"
OUTPUT_NAMES = {"activity": "activity_data", "hierarchy": "employee_hierarchy", "merged": "output"}


def work_item_key(df: DataFrame, out: str = KEY_COL) -> DataFrame:
    """The work-item ``JoinKey``: eight normalised parts, seven for CART rows."""
    short = [p for p in WORK_ITEM_PARTS if p != SHORT_KEY_DROPS]
    return with_join_key(
        df,
        WORK_ITEM_PARTS,
        variants=[(F.col("data_source") == F.lit(SHORT_KEY_SOURCE), short)],
        out=out,
        sep=KEY_SEP,
    )
