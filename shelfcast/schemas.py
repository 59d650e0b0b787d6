"""Canonical table schemas.

Keys are strings everywhere; weeks are ``int`` in ``YYYYWW`` form; quantities are
``bigint``; sales amounts stay text (``'$12.34'``) until they are read.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

WEEK = "f5c_calendar_week"
STORE = "store_number"
ITEM = "f5c_item_number"
SUBCATEGORY = "subcategory_number"
STYLE = "style"
UNITS = "pos_quantity_this_year"
SOURCE = "source_table"

KEY = [STORE, ITEM]
STYLE_KEY = [STORE, STYLE]
FACT_KEY = [WEEK, STORE, ITEM]
REQUIRED_COLUMNS = [WEEK, SUBCATEGORY, STORE, ITEM]

CATEGORY_A = "category_a"
GENERAL = "non-category_a"
CATEGORY_A_SUBCATEGORIES = ("1001", "1002")

QUANTITY_COLUMNS = [
    "pos_quantity_this_year",
    "pos_quantity_last_year",
    "store_in_warehouse_quantity_this_year",
    "store_in_warehouse_quantity_last_year",
    "store_in_transit_quantity_this_year",
    "store_in_transit_quantity_last_year",
    "store_on_order_quantity_this_year",
    "store_on_order_quantity_last_year",
    "store_on_hand_quantity_this_year",
    "store_on_hand_quantity_last_year",
    "store_on_hand_quantity_this_year_eop",
    "store_on_hand_quantity_last_year_eop",
    "max_shelf_quantity_this_year",
    "traited_store_count_this_year",
    "traited_store_count_last_year",
    "valid_store_count_this_year",
]
SALES_COLUMNS = ["pos_sales_this_year", "pos_sales_last_year"]
CATEGORY_A_EXTRAS = [
    "vendor_stock_id",
    "modular_based_merchandising_description",
    "color_description",
    "trait_description",
]


def _fields(kind, names):
    return [StructField(name, kind(), True) for name in names]


POS_FACT = StructType(
    [
        StructField(WEEK, IntegerType(), False),
        StructField("subcategory_description", StringType(), True),
        StructField(SUBCATEGORY, StringType(), True),
        StructField(STORE, StringType(), False),
        StructField(ITEM, StringType(), False),
        *_fields(LongType, QUANTITY_COLUMNS),
        *_fields(StringType, SALES_COLUMNS),
        *_fields(StringType, CATEGORY_A_EXTRAS),
        StructField(SOURCE, StringType(), True),
    ]
)

POS_ALL_COLUMNS = [name for name in POS_FACT.fieldNames() if name != "modular_based_merchandising_description"]

DIM_STORES = StructType(
    _fields(StringType, ["store_number", "state", "region", "zip_code"])
    + _fields(IntegerType, ["merch_zone_number"])
)
DIM_ITEMS = StructType(
    _fields(StringType, ["f5c_item_number", "subcategory", "description", "style_id"])
    + _fields(DoubleType, ["cost", "retail"])
    + _fields(StringType, ["item_status"])
)
DIM_CAPACITY = StructType(_fields(StringType, ["item"]) + _fields(IntegerType, ["capacity"]))
DIM_CASE_PACK = StructType(
    _fields(StringType, ["item_nbr", "status"]) + _fields(IntegerType, ["vnpk_qty", "case_pack_qty"])
)
DIM_STYLE = StructType(
    _fields(StringType, ["customer_style_number", "internal_style_color", "product_category", "size"])
)
DIM_WEEK_MAPPING = StructType(
    _fields(IntegerType, ["ty_week", "ly_week"]) + _fields(StringType, ["notes"])
)
WEATHER_FORECAST = StructType(
    _fields(StringType, ["region"])
    + _fields(DateType, ["week_imported"])
    + _fields(DoubleType, ["tw_pct", "nw_pct", "m1_pct", "m2_pct", "m3_pct"])
)
CLIENT_FORECAST = StructType(
    _fields(StringType, ["f5c_item_nbr", "subcategory_nbr"])
    + _fields(IntegerType, ["f5c_calendar_week"])
    + _fields(StringType, ["store_nbr"])
    + _fields(LongType, ["final_forecast_each_quantity"])
    + _fields(StringType, ["vendor_stock_id"])
)
CALENDAR_WEEK = StructType(_fields(IntegerType, ["week", "week_idx"]))

SCHEMAS = {
    "pos_fact": POS_FACT,
    "dim_stores": DIM_STORES,
    "dim_items": DIM_ITEMS,
    "dim_capacity": DIM_CAPACITY,
    "dim_case_pack": DIM_CASE_PACK,
    "dim_category_a_style": DIM_STYLE,
    "dim_week_mapping": DIM_WEEK_MAPPING,
    "fact_forecast_vendor": WEATHER_FORECAST,
    "client_forecast_fact": CLIENT_FORECAST,
    "calendar_week": CALENDAR_WEEK,
}
