"""Table schemas, product levels and the fixed value lists of the feed formats."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Level:
    """One product level a retailer may report at."""
    name: str
    keys: tuple[str, ...]
    rollup: bool        # rows come per store and are summed to the keys before mapping


LEVELS = {
    "serial": Level("serial", ("product_id",), rollup=False),
    "sku": Level("sku", ("style", "color", "size"), rollup=True),
    "style": Level("style", ("style",), rollup=True),
}
KEY_COLUMNS = ("product_id", "style", "color", "size")

# Header spellings (lower case, letters and digits only) and the standard column each one means.
SYNONYMS = {
    "weekdate": "week_date", "weekending": "week_date", "weekenddate": "week_date",
    "client": "client_id", "clientid": "client_id", "vendor": "client_id",
    "retailer": "retailer_id", "retailerid": "retailer_id",
    "productid": "product_id", "serial": "product_id", "serialnumber": "product_id",
    "style": "style", "color": "color", "size": "size",
    "sales": "sales", "salesamount": "sales", "netsales": "sales",
    "inventory": "inventory", "inventoryunits": "inventory", "onhandunits": "inventory", "onhand": "inventory",
    "store": "store", "storenumber": "store",
}

# Reject texts, in the order the rules are tried. The last two are followed by the feed's own id.
REJECT_TOTAL = "summary/total row"
REJECT_WEEK = "unparseable week_date"
REJECT_SATURDAY = "week_date is not a Saturday"
REJECT_KEY = "missing product key"
REJECT_SALES = "unparseable sales"
REJECT_INVENTORY = "unparseable inventory"
REJECT_CLIENT = "client is not "
REJECT_RETAILER = "retailer is not "
# An own rule, tried before them.
REJECT_RAGGED = "more cells than the header"

# Limits.
MAX_DROPS_PER_LOAD = 20
MAX_RESULT_ROWS = 500
MAX_KNOWN_VALUES = 200
MAX_EVIDENCE_KEYS = 50
MAX_EVIDENCE_ROWS = 20
MAX_ERROR_CHARS = 2000
MAX_LABEL_CHARS = 500

# The text columns every reader delivers. NULL means the layout has no such column; a blank cell is ''.
FEED_COLUMNS = ("week_date", "client_id", "retailer_id", "product_id", "style", "color", "size", "sales", "inventory")

MONEY = T.DecimalType(18, 2)


TYPES = {"string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
         "smallint": T.ShortType(), "bigint": T.LongType(), "decimal(18,2)": MONEY, "decimal(10,2)": T.DecimalType(10, 2),
         "array<string>": T.ArrayType(T.StringType()), "map<string,string>": T.MapType(T.StringType(), T.StringType())}


def table_schema(text: str) -> T.StructType:
    """`name type` pairs parted by commas; needs no running session, unlike StructType.fromDDL."""
    pairs = (field.split(" ") for field in " ".join(text.split()).split(", "))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


RAW_FEED = table_schema("""source_file string, week_date string, client_id string, retailer_id string, product_id string,
    style string, color string, size string, sales string, inventory string, raw_names array<string>,
    raw_cells array<string>, layout_error string""")

PIPELINE_CONFIG = table_schema("""pipeline_id string, client_id string, retailer_id string, product_level string,
    source_type string, source_location string, file_format string, schedule string, lookback_weeks smallint,
    is_active boolean, promoted_to_prod boolean""")
CLIENT = table_schema("client_id string, client_name string, category string")
RETAILER = table_schema("retailer_id string, retailer_name string")
PRODUCT = table_schema("""product_id string, client_id string, product_grain string, style string, color string, size string,
    product_name string, category string, unit_price decimal(10,2)""")
PRODUCT_STM = table_schema("""client_id string, product_level string, src_product_id string, style string, color string,
    size string, product_id string""")

FILES = table_schema("load_id string, source_file string, file_week date")
# A file is known by its path, length and time of modification: one sent again under its name is another file.
FILE_IDENTITY = table_schema("source_file string, length bigint, modified timestamp")
LOADS = table_schema("""load_id string, pipeline_id string, client_id string, retailer_id string, product_level string,
    load_type string, window_start date, window_end date""")

LANDING = table_schema("""load_id string, week_date date, client_id string, retailer_id string, product_level string,
    product_id string, style string, color string, size string, sales decimal(18,2), inventory bigint""")
PRESTAGE = table_schema("""load_id string, week_date date, client_id string, retailer_id string, product_level string,
    product_id string, style string, color string, size string, sales decimal(18,2), inventory bigint,
    source_rows bigint""")
REJECTS = table_schema("load_id string, source_file string, reject_reason string, raw map<string,string>")
STAGING = table_schema("""load_id string, week_date date, client_id string, retailer_id string, product_level string,
    src_product_key string, product_id string, sales decimal(18,2), inventory bigint""")
ETL_STATS = table_schema("""load_id string, source string, week_date date, client_id string, retailer_id string,
    row_count bigint, sales decimal(18,2), inventory bigint, created_at timestamp""")
LOAD_AUDIT_EVENT = table_schema("""load_id string, event_ts timestamp, pipeline_id string, run_id string, load_type string,
    source_file string, window_start date, window_end date, status string, parse_stats string, fact_inserted bigint,
    fact_updated bigint, error_message string, started_at timestamp, finished_at timestamp""")
LOAD_FILES = table_schema("""load_id string, source_file string, file_week_end date, raw_rows bigint, parsed_rows bigint,
    rows_used bigint, superseded_rows bigint, parse_rejects bigint, out_of_window bigint, loaded_at timestamp""")
UNRECOGNISED_FILES = table_schema("source_file string, seen_at timestamp")
LOADED_FILES = table_schema("""load_id string, pipeline_id string, source_file string, file_week date, length bigint,
    modified timestamp, loaded_at timestamp""")
BACKLOG = table_schema("""pipeline_id string, source_file string, file_week date, file_format string, length bigint,
    modified timestamp, turn bigint""")
UNMAPPED = table_schema("""load_id string, src_product_key string, first_week date, last_week date, rows bigint,
    sales decimal(18,2)""")
FACT_SALES = table_schema("""week_date date, client_id string, retailer_id string, product_id string, sales decimal(18,2),
    inventory bigint, load_id string, inserted_at timestamp, updated_at timestamp""")
# As stored: with the week of the drop that a row comes from.
FACT_STORED = T.StructType([*FACT_SALES.fields, T.StructField("file_week", T.DateType())])
FACT_WEEKS = table_schema("week_date date, client_id string, retailer_id string, rows bigint, sales decimal(18,2), inventory bigint")
FACT_PRODUCTS = table_schema("client_id string, retailer_id string, product_id string")
