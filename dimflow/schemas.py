"""Record layouts of the zones and warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Dataset names, record layouts, required keys, tracked columns, sample limits
# and verdict texts. They have to be exactly these for files and results to be interchangeable.

DATASETS = ("customers", "plans", "activity_logs")

_LAYOUTS = {
    "customers": """
        customer_id string, first_name string, last_name string, email string,
        phone string, gender string, date_of_birth string, address string,
        state string, country string, registration_date string,
        registration_channel string, plan_id string, status string""",
    "plans": """
        plan_id string, plan_name string, monthly_price double,
        data_allowance_gb int, voice_minutes int, sms_allowance int,
        roaming_enabled string, validity_days int, plan_category string""",
    "activity_logs": """
        event_id string, customer_id string, event_type string,
        event_timestamp string, device_type string, ip_address string,
        network_type string, payload string""",
    "stg_customers": """
        customer_id string, first_name string, last_name string, email string,
        phone string, country string, status string, plan_id string,
        ingestion_ts timestamp_ntz""",
    "stg_plans": """
        plan_id string, plan_name string, plan_category string,
        monthly_price decimal(10,2), data_allowance_gb int, voice_minutes int,
        sms_allowance int, roaming_enabled boolean, validity_days int,
        ingestion_ts timestamp_ntz""",
    "stg_activity": """
        event_id string, customer_id string, event_type string,
        event_timestamp timestamp_ntz, device_type string, network_type string,
        ingestion_ts timestamp_ntz""",
    "dim_plan": """
        plan_sk bigint, plan_id string, plan_name string, plan_category string,
        monthly_price decimal(10,2), data_allowance_gb int, voice_minutes int,
        sms_allowance int, roaming_enabled boolean, validity_days int,
        is_active boolean, updated_at timestamp_ntz""",
    "dim_customer": """
        customer_sk bigint, customer_id string, first_name string,
        last_name string, email string, phone string, country string,
        status string, plan_sk bigint, effective_start_date timestamp_ntz,
        effective_end_date timestamp_ntz, is_current boolean,
        ingestion_ts timestamp_ntz""",
    "fact_activity": """
        event_id string, customer_id string, customer_sk bigint, plan_sk bigint,
        event_type string, event_timestamp timestamp_ntz, device_type string,
        network_type string, ingestion_ts timestamp_ntz""",
}

REQUIRED_KEYS = {
    "customers": ["customer_id"],
    "plans": ["plan_id"],
    "activity_logs": ["event_id", "customer_id"],
}

RECORD_KEYS = {"customers": "customer_id", "plans": "plan_id", "activity_logs": "event_id"}

# Tracked customer attributes and the value that a NULL counts as when two are compared.
TRACKED = {"email": "", "phone": "", "status": "", "plan_sk": -1}

SAMPLE_BYTES = 524288
SAMPLE_LINES = 300
MIN_CSV_ROWS = 2

OK = "ok"
BAD_NDJSON = "invalid_ndjson_format"
NO_JSON = "no_json_lines_detected"
MISSING_FIELDS = "missing_fields_"
MISSING_COLUMNS = "missing_columns_"
NO_ROWS = "no_data_rows_found"
UNKNOWN_FOLDER = "unknown_folder_structure"
READ_ERROR = "error_reading_file_"

OPEN_END = "9999-12-31"

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "decimal": T.DecimalType(10, 2),
    "timestamp_ntz": T.TimestampNTZType(),
}


def layout(name: str) -> T.StructType:
    """The record layout called ``name`` as a nullable Spark schema."""
    pairs = (part.split() for part in _LAYOUTS[name].replace("(10,2)", "").split(","))
    return T.StructType([T.StructField(column, _TYPES[kind]) for column, kind in pairs])
