"""Column lists, table schemas and fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

CANONICAL_COLUMNS = [
    "invoice_no", "product_code", "description", "quantity", "invoice_date",
    "unit_price", "customer_id", "country", "source",
]

# ---- fixed values -------------------------------------------------------------------------
# Raw header -> canonical name, one map per export layout.
SOURCE1_COLUMNS = {
    "InvoiceNo": "invoice_no", "StockCode": "product_code", "Description": "description",
    "Quantity": "quantity", "InvoiceDate": "invoice_date", "UnitPrice": "unit_price",
    "CustomerID": "customer_id", "Country": "country",
}
SOURCE2_COLUMNS = {
    "Invoice": "invoice_no", "StockCode": "product_code", "Description": "description",
    "Quantity": "quantity", "InvoiceDate": "invoice_date", "Price": "unit_price",
    "Customer ID": "customer_id", "Country": "country",
}

# Cell texts the CSV reader treats as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Stripped texts that the cleaning rules treat as blank.
BLANK_TOKENS = ["", "nan", "NaN", "None"]
# Reject reasons, in the order the rules are applied.
DUPLICATE = "Duplicado"
NOT_NUMERIC = "quantity o unit_price no es numerico"
NO_CODE = "product_code nulo o vacio"
BAD_DATE = "Fecha invalida"
BAD_PRICE = "Precio Unitario <=0"
TOO_LARGE = "Valor fuera de rango"
NO_REASON = "Sin motivo"
# Default texts.
NO_DESCRIPTION = "SIN DESCRIPCION"
ANONYMOUS = "ANONYMOUS"
UNKNOWN_COUNTRY = "Unknown"
DEFAULT_CATEGORY = "Varios"
SUPPLIER_COUNTRY = "United Kingdom"
SALE, RETURN = "SALE", "RETURN"
ALERT_TEXT = "⚠️ Alto revenue + alta devolución"
# -------------------------------------------------------------------------------------------

DIM_PRODUCTS = T.StructType([
    T.StructField("product_code", T.StringType()),
    T.StructField("canonical_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])
DIM_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("is_anonymous", T.BooleanType()),
    T.StructField("first_seen_at", T.DateType()),
    T.StructField("last_seen_at", T.DateType()),
])
FACT_TRANSACTIONS = T.StructType([
    T.StructField("invoice_no", T.StringType()),
    T.StructField("product_code", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("transaction_date", T.TimestampType()),
    T.StructField("date_id", T.DateType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("unit_price", T.DecimalType(24, 4)),
    T.StructField("gross_revenue", T.DecimalType(28, 4)),
    T.StructField("country", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_row_hash", T.StringType()),
])
DAILY_KEYS = ["date_id", "product_code", "country"]
DAILY_MEASURES = [
    "gross_sales", "total_returns", "net_revenue",
    "sale_quantity", "return_quantity", "sale_count", "return_count",
]
# Measures are wider than one line's amounts: they hold sums over any number of lines.
FACT_DAILY_REVENUE = T.StructType(
    [
        T.StructField("date_id", T.DateType()),
        T.StructField("product_code", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
    + [T.StructField(name, T.DecimalType(38, 4)) for name in DAILY_MEASURES[:3]]
    + [T.StructField(name, T.LongType()) for name in DAILY_MEASURES[3:]]
)
REJECT_LOG = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("invoice_no", T.StringType()),
    T.StructField("product_code", T.StringType()),
    T.StructField("rejection_reason", T.StringType()),
    T.StructField("raw_data", T.StringType()),
])
# As stored: with the time a row was written, and in the rollup the number of the load that changed it last.
STORED_FACTS = T.StructType([*FACT_TRANSACTIONS.fields, T.StructField("loaded_at", T.TimestampType())])
STORED_DAILY = T.StructType([*FACT_DAILY_REVENUE.fields, T.StructField("updated_at", T.TimestampType()),
                             T.StructField("load_no", T.LongType())])
STORED_REJECTS = T.StructType([*REJECT_LOG.fields, T.StructField("rejected_at", T.TimestampType()),
                               T.StructField("run_id", T.StringType())])
# Sums of sales (kind sums) and bitmaps of numbered invoices and customers, see operators.monthly.
MONTHLY_KEYS = ["country", "is_anonymous", "kind", "part"]
MONTHLY_SALES = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("is_anonymous", T.BooleanType()),
    T.StructField("kind", T.StringType()),
    T.StructField("part", T.LongType()),
    T.StructField("bits", T.BinaryType()),
    T.StructField("lines", T.LongType()),
    T.StructField("revenue", T.DecimalType(38, 4)),
])
NUMBERS = T.StructType([T.StructField("key", T.StringType()), T.StructField("number", T.LongType())])
PIPELINE_RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("dag_run_id", T.StringType()),
    T.StructField("execution_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("records_extracted", T.LongType()),
    T.StructField("records_loaded", T.LongType()),
    T.StructField("records_rejected", T.LongType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("notes", T.StringType()),
])
CATALOGUE = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("supplier_country", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
])

# Declared constraints of the warehouse tables, checked by operators.quality.
PRIMARY_KEYS = {
    "dim_products": ["product_code"],
    "dim_customers": ["customer_id"],
    "dim_date": ["date_id"],
    "fact_transactions": ["source_row_hash"],
    "fact_daily_revenue": DAILY_KEYS,
    "log_pipeline_runs": ["run_id"],
}
FOREIGN_KEYS = [
    ("fact_transactions", "product_code", "dim_products"),
    ("fact_transactions", "customer_id", "dim_customers"),
    ("fact_transactions", "date_id", "dim_date"),
    ("fact_daily_revenue", "date_id", "dim_date"),
    ("fact_daily_revenue", "product_code", "dim_products"),
]
NOT_NULL = {
    "dim_products": ["product_code"],
    "dim_customers": ["customer_id"],
    "dim_date": ["date_id", "year", "quarter", "month", "month_name", "week_of_year",
                 "day_of_month", "day_of_week", "day_name", "is_weekend"],
    "fact_transactions": ["invoice_no", "product_code", "customer_id", "transaction_date",
                          "date_id", "quantity", "unit_price", "gross_revenue",
                          "transaction_type", "source", "source_row_hash"],
    "fact_daily_revenue": DAILY_KEYS,
    "log_rejected_records": ["source", "rejection_reason"],
    "log_pipeline_runs": ["run_id"],
}
MAX_LENGTHS = {
    "dim_products": {"product_code": 30, "canonical_name": 500, "category": 100},
    "dim_customers": {"customer_id": 20},
    "dim_date": {"month_name": 20, "day_name": 20},
    "fact_transactions": {"invoice_no": 30, "product_code": 30, "customer_id": 20,
                          "country": 100, "transaction_type": 10, "source": 50,
                          "source_row_hash": 64},
    "fact_daily_revenue": {"product_code": 30, "country": 100},
    "log_rejected_records": {"source": 50, "invoice_no": 30, "product_code": 30},
    "log_pipeline_runs": {"run_id": 200, "dag_run_id": 200, "status": 20},
}
