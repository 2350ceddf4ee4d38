"""Table schemas and the fixed header vocabulary of the landing files."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Column names (fixed values: they must equal the reference's output headers)
ENGINE_SERIAL = "Engine_serial"
OPTION = "option_assembly_num"
DESIGN_CONFIG = "design_config_2"
SHOP_ORDER = "shop_order_num"
BUILD_YEAR = "build_year"
KEY = "esn_config_design_config_Shop_order_num"
COUNT = "Engine_serial_count"
CHILD = "Child_Part_Number"
OPTION_NUMBER = "Option_Number"
CONFIG_ID = "config_id"

CHILD_PART_OPTION = _schema((OPTION_NUMBER, S), (CHILD, S))
BOM_CONFIG = _schema((ENGINE_SERIAL, S), (DESIGN_CONFIG, S), (BUILD_YEAR, I))
BOM_OPTION = _schema(("design_configuration", S), (SHOP_ORDER, S), (ENGINE_SERIAL, S),
                     (OPTION, S), ("build_year_2", S))
SERIAL_JOIN = _schema((ENGINE_SERIAL, S), (OPTION, S), (DESIGN_CONFIG, S), (SHOP_ORDER, S),
                      (BUILD_YEAR, I))
KEYED = _schema((ENGINE_SERIAL, S), (OPTION, S), (KEY, S), (BUILD_YEAR, I))
ROLLUP = _schema((COUNT, L), (OPTION, S), (KEY, S), (BUILD_YEAR, I))
LATEST = ROLLUP
EXPANDED = _schema((COUNT, L), (OPTION, S), (KEY, S), (BUILD_YEAR, I), (CHILD, S))
BEST_PER_CHILD = EXPANDED

# ---------------------------------------------------------------------------
# Landing-file header vocabulary (must equal the reference's).
# Matching trims the header name; config/child matching is case-insensitive.
# ---------------------------------------------------------------------------

# Option files: old header name -> new name, then the kept columns in order.
OPTION_RENAMES = {"engine_serial_num": "Engine_serial", "build_upfit_date": "build_year_2"}
OPTION_KEEP = ["design_configuration", "shop_order_num", "Engine_serial",
               "option_assembly_num", "build_year_2"]

# Option-child files: any of these names is the option column (last match in
# the header wins); the child column is "child_part".
CHILD_OPTION_SYNONYMS = ["rev_option_no", "option_number", "option_no"]
CHILD_PART_HEADER = "child_part"

# Config files: required header names -> output names.
CONFIG_HEADERS = {"engine_serial_num": "Engine_serial",
                  "design_config_num": "design_config_2",
                  "build_year": "build_year"}

# Names accepted for the option column of a child table at join time
# (case-insensitive, byte-order mark ignored, first match wins).
JOIN_OPTION_SYNONYMS = ["Option_Number", "option_assembly_num", "option_number", "option",
                        "option_num"]

# Landing folders and the half-year period labels.
FIRST_HALF = "01"
SECOND_HALF = "02"
UNKNOWN_YEAR = "XXXX"
DEFAULT_MONTH = "01"
