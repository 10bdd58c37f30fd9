"""The same results in SQL, written independently for DuckDB over the given tables."""

from __future__ import annotations

from checks.inputs import (
    FIRST_DAY, HOME_COUNTRY, KEYWORDS, LAST_DAY, RAW_SOURCE1, RAW_SOURCE2, RETAIL_BASE,
)
from tallyline.sources.keywords import CATALOGUE_KEYWORDS, PIPELINE_KEYWORDS, KeywordMap


def _case(column: str, words: KeywordMap) -> str:
    tests = " ".join(
        "WHEN " + " OR ".join(f"contains(upper({column}), '{w}')" for w in ws) + f" THEN '{name}'"
        for name, ws in words.categories.items()
    )
    return f"CASE {tests} ELSE '{words.default}' END"


def _money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DECIMAL(38,2))"


def _pct(part: str, total: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({part} AS DOUBLE) / NULLIF({total}, 0) * 100, {digits}) AS DECIMAL(38,{digits}))"


def _ratio(part: str, total: str) -> str:
    return f"CAST(ROUND(CAST({part} AS DOUBLE) / NULLIF({total}, 0), 2) AS DECIMAL(38,2))"


def _int(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _number_text(expr: str) -> str:
    return (f"CASE WHEN {expr} = trunc({expr}) THEN CAST(CAST({expr} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({expr} AS VARCHAR) END")


_LINE_COLUMNS = "invoice_no, product_code, description, quantity, invoice_date, unit_price, customer_id, country, source"
_TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_PARSE = ("coalesce(try_strptime({0}, '%m/%d/%Y %H:%M'), try_strptime({0}, '%Y-%m-%d %H:%M:%S'))")
_UTC = _TS.format("invoice_ts") + " || '+00:00'"

# Declared constraints of the warehouse, written out: the lists that the library checks must equal these.
ALERT_TEXT = "⚠️ Alto revenue + alta devolución"
PRIMARY_KEYS = {
    "dim_products": ["product_code"], "dim_customers": ["customer_id"], "dim_date": ["date_id"],
    "fact_transactions": ["source_row_hash"], "fact_daily_revenue": ["date_id", "product_code", "country"],
    "log_pipeline_runs": ["run_id"],
}
FOREIGN_KEYS = [
    ("fact_transactions", "product_code", "dim_products"), ("fact_transactions", "customer_id", "dim_customers"),
    ("fact_transactions", "date_id", "dim_date"), ("fact_daily_revenue", "date_id", "dim_date"),
    ("fact_daily_revenue", "product_code", "dim_products"),
]
NOT_NULL = {
    "dim_products": ["product_code"], "dim_customers": ["customer_id"],
    "dim_date": ["date_id", "year", "quarter", "month", "month_name", "week_of_year", "day_of_month", "day_of_week", "day_name", "is_weekend"],
    "fact_transactions": ["invoice_no", "product_code", "customer_id", "transaction_date", "date_id", "quantity", "unit_price",
                          "gross_revenue", "transaction_type", "source", "source_row_hash"],
    "fact_daily_revenue": ["date_id", "product_code", "country"],
    "log_rejected_records": ["source", "rejection_reason"], "log_pipeline_runs": ["run_id"],
}
MAX_LENGTHS = {
    "dim_products": {"product_code": 30, "canonical_name": 500, "category": 100}, "dim_customers": {"customer_id": 20},
    "dim_date": {"month_name": 20, "day_name": 20},
    "fact_transactions": {"invoice_no": 30, "product_code": 30, "customer_id": 20, "country": 100, "transaction_type": 10,
                          "source": 50, "source_row_hash": 64},
    "fact_daily_revenue": {"product_code": 30, "country": 100},
    "log_rejected_records": {"source": 50, "invoice_no": 30, "product_code": 30},
    "log_pipeline_runs": {"run_id": 200, "dag_run_id": 200, "status": 20},
}
_CTES = {
    "retail_base": RETAIL_BASE,
    "raw1": RAW_SOURCE1.replace("`", '"'),
    "raw2": RAW_SOURCE2.replace("`", '"'),
    "text1": """SELECT "InvoiceNo" AS invoice_no, "StockCode" AS product_code, "Description" AS description,
        "Quantity" AS quantity, "InvoiceDate" AS invoice_date, "UnitPrice" AS unit_price,
        "CustomerID" AS customer_id, "Country" AS country, 'source1' AS source FROM raw1""",
    "text2": """SELECT "Invoice" AS invoice_no, "StockCode" AS product_code, "Description" AS description,
        "Quantity" AS quantity, "InvoiceDate" AS invoice_date, "Price" AS unit_price,
        "Customer ID" AS customer_id, "Country" AS country, 'source2' AS source FROM raw2""",
    "texts": "SELECT * FROM text1 UNION ALL SELECT * FROM text2",
    "combined": f"SELECT * REPLACE ({_TS.format(_PARSE.format('invoice_date'))} AS invoice_date) FROM texts",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY invoice_no, product_code, quantity
        ORDER BY source DESC, invoice_date NULLS LAST, description NULLS LAST, unit_price NULLS LAST,
        customer_id NULLS LAST, country NULLS LAST) AS rn FROM combined""",
    "cleaned": """SELECT invoice_no, product_code AS raw_code, description AS raw_description,
        customer_id AS raw_customer, invoice_date, country, source,
        try_cast(quantity AS DOUBLE) AS quantity, try_cast(unit_price AS DOUBLE) AS unit_price,
        nullif(trim(product_code), '') AS code_key,
        regexp_replace(upper(nullif(trim(product_code), '')), '\\s+', '', 'g') AS product_code,
        nullif(trim(description), '') AS description,
        try_strptime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_ts,
        coalesce(CAST(CAST(try_cast(customer_id AS DOUBLE) AS BIGINT) AS VARCHAR),
                 nullif(trim(customer_id), ''), 'ANONYMOUS') AS customer_id
        FROM ranked WHERE rn = 1""",
    "typed": """SELECT *, CAST(invoice_ts AS DATE) AS date_id, abs(quantity) * unit_price AS gross_revenue,
        CASE WHEN quantity > 0 THEN 'SALE' WHEN quantity <= 0 THEN 'RETURN' END AS transaction_type
        FROM cleaned""",
    "checked": """SELECT *, CASE
        WHEN quantity IS NULL OR unit_price IS NULL THEN 'quantity o unit_price no es numerico'
        WHEN code_key IS NULL THEN 'product_code nulo o vacio'
        WHEN invoice_ts IS NULL THEN 'Fecha invalida'
        WHEN transaction_type = 'SALE' AND unit_price <= 0 THEN 'Precio Unitario <=0' END AS reason
        FROM typed""",
    "past_code": "SELECT * FROM checked WHERE reason IS NULL OR reason IN ('Fecha invalida', 'Precio Unitario <=0')",
    "past_date": "SELECT * FROM checked WHERE reason IS NULL OR reason = 'Precio Unitario <=0'",
    "fill": """SELECT code_key, description AS fill_name FROM (
        SELECT code_key, description, row_number() OVER (PARTITION BY code_key
            ORDER BY count(*) DESC, description) AS r
        FROM past_code WHERE description IS NOT NULL GROUP BY code_key, description) WHERE r = 1""",
    "valid": """SELECT c.* REPLACE (upper(coalesce(c.description, f.fill_name, 'SIN DESCRIPCION')) AS description,
        coalesce(c.country, 'Unknown') AS country)
        FROM checked c LEFT JOIN fill f ON c.code_key = f.code_key WHERE reason IS NULL""",
    "names": """SELECT product_code, description AS canonical_name FROM (
        SELECT product_code, description, row_number() OVER (PARTITION BY product_code
            ORDER BY count(*) DESC, description) AS r
        FROM valid GROUP BY product_code, description) WHERE r = 1""",
    "products": f"SELECT product_code, canonical_name, {_case('canonical_name', KEYWORDS)} AS category FROM names",
    "customers": "SELECT DISTINCT customer_id, customer_id = 'ANONYMOUS' AS is_anonymous FROM valid",
    "calendar": f"""SELECT CAST(d AS DATE) AS date_id, CAST(year(d) AS INT) AS year,
        CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, monthname(d) AS month_name,
        CAST(week(d) AS INT) AS week_of_year, CAST(day(d) AS INT) AS day_of_month,
        CAST(isodow(d) - 1 AS INT) AS day_of_week, dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend
        FROM (SELECT unnest(generate_series(TIMESTAMP '{FIRST_DAY}', TIMESTAMP '{LAST_DAY}', INTERVAL 1 DAY)) AS d)""",
    "hashed": f"""SELECT *, sha256(coalesce(invoice_no, '') || '|' || product_code || '|' ||
        {_number_text('quantity')} || '|' || {_UTC} || '|' || source) AS source_row_hash FROM valid""",
    "facts": """SELECT * EXCLUDE (r) FROM (
        SELECT invoice_no, product_code, customer_id, invoice_ts AS transaction_date, date_id,
        CAST(trunc(quantity) AS BIGINT) AS quantity, CAST(unit_price AS DECIMAL(24,4)) AS unit_price,
        CAST(gross_revenue AS DECIMAL(28,4)) AS gross_revenue, country, transaction_type, source,
        source_row_hash, row_number() OVER (PARTITION BY source_row_hash ORDER BY invoice_no) AS r
        FROM hashed) WHERE r = 1""",
    "daily": """SELECT date_id, product_code, country,
        coalesce(sum(gross_revenue) FILTER (WHERE transaction_type = 'SALE'), 0) AS gross_sales,
        coalesce(sum(gross_revenue) FILTER (WHERE transaction_type = 'RETURN'), 0) AS total_returns,
        coalesce(sum(gross_revenue) FILTER (WHERE transaction_type = 'SALE'), 0)
          - coalesce(sum(gross_revenue) FILTER (WHERE transaction_type = 'RETURN'), 0) AS net_revenue,
        coalesce(sum(quantity) FILTER (WHERE transaction_type = 'SALE'), 0) AS sale_quantity,
        coalesce(sum(abs(quantity)) FILTER (WHERE transaction_type = 'RETURN'), 0) AS return_quantity,
        count(*) FILTER (WHERE transaction_type = 'SALE') AS sale_count,
        count(*) FILTER (WHERE transaction_type = 'RETURN') AS return_count
        FROM facts GROUP BY date_id, product_code, country""",
    "months": """SELECT d.year, d.month, d.month_name, strftime(d.date_id, '%Y-%m') AS periodo,
        sum(gross_sales) AS g, sum(total_returns) AS r, sum(net_revenue) AS n,
        sum(sale_count) AS sales, sum(return_count) AS backs
        FROM daily f JOIN calendar d ON f.date_id = d.date_id GROUP BY ALL""",
    "per_product": """SELECT p.product_code, p.canonical_name, p.category, sum(gross_sales) AS g,
        sum(total_returns) AS r, sum(net_revenue) AS n, sum(sale_quantity) AS units,
        sum(sale_count) AS sales, sum(return_count) AS backs
        FROM daily f JOIN products p ON f.product_code = p.product_code
        GROUP BY p.product_code, p.canonical_name, p.category""",
    "per_category": """SELECT category, sum(g) AS g, sum(r) AS r, sum(n) AS n, sum(sales) AS sales,
        sum(backs) AS backs FROM per_product GROUP BY category""",
    "per_country": """SELECT country, count(DISTINCT invoice_no) AS inv, count(*) AS lines,
        sum(gross_revenue) AS rev FROM facts WHERE transaction_type = 'SALE' GROUP BY country""",
    "per_type": """SELECT c.is_anonymous, count(DISTINCT f.customer_id) AS cust,
        count(DISTINCT f.invoice_no) AS inv, count(*) AS lines, sum(f.gross_revenue) AS rev
        FROM facts f JOIN customers c ON f.customer_id = c.customer_id
        WHERE f.transaction_type = 'SALE' GROUP BY c.is_anonymous""",
    "critical": """SELECT * FROM (SELECT *, percent_rank() OVER (ORDER BY g DESC) AS rank_g,
            percent_rank() OVER (ORDER BY rate DESC) AS rank_r
        FROM (SELECT *, CASE WHEN g > 0 THEN CAST(r AS DOUBLE) / g * 100 ELSE 0 END AS rate
              FROM per_product WHERE sales >= 20)) WHERE rank_r <= 0.20 AND rank_g <= 0.30""",
    "rejected": f"""SELECT invoice_no, product_code, description, quantity, invoice_date, unit_price,
          customer_id, country, source, NULL AS transaction_type, NULL AS invoice_date_utc,
          NULL AS date_id, 'Duplicado' AS rejection_reason FROM ranked WHERE rn > 1
        UNION ALL
        SELECT invoice_no,
          CASE WHEN reason LIKE 'quantity%' THEN raw_code WHEN reason LIKE 'product%' THEN c.code_key
               ELSE product_code END,
          CASE WHEN reason LIKE 'quantity%' OR reason LIKE 'product%' THEN raw_description
               ELSE upper(coalesce(c.description, f.fill_name, 'SIN DESCRIPCION')) END,
          {_number_text('quantity')}, invoice_date, {_number_text('unit_price')},
          CASE WHEN reason LIKE 'Precio%' THEN customer_id ELSE raw_customer END, country, source,
          CASE WHEN reason LIKE 'Precio%' THEN transaction_type END,
          CASE WHEN reason LIKE 'Precio%' THEN {_UTC} END,
          CASE WHEN reason LIKE 'Precio%' THEN CAST(date_id AS VARCHAR) END, reason
        FROM checked c LEFT JOIN fill f ON c.code_key = f.code_key WHERE reason IS NOT NULL""",
    "log": """SELECT source, invoice_no, product_code, rejection_reason, CAST(to_json({
        'invoice_no': invoice_no, 'product_code': product_code, 'description': description,
        'quantity': quantity, 'invoice_date': invoice_date, 'unit_price': unit_price,
        'customer_id': customer_id, 'country': country, 'source': source,
        'transaction_type': transaction_type, 'invoice_date_utc': invoice_date_utc,
        'date_id': date_id}) AS VARCHAR) AS raw_data FROM rejected""",
    "runs": """SELECT 'run-1' AS run_id, 'run-1' AS dag_run_id, DATE '2001-12-31' AS execution_date,
        'SUCCESS' AS status, (SELECT count(*) FROM combined) AS records_extracted,
        (SELECT count(*) FROM facts) AS records_loaded,
        (SELECT count(*) FROM rejected) AS records_rejected""",
    "catalogue_lines": f"""SELECT upper(trim(product_code)) AS code, trim(description) AS name,
        {_PARSE.format('invoice_date')} AS ts, source, invoice_no, quantity, invoice_date, unit_price,
        customer_id, country FROM combined
        WHERE product_code IS NOT NULL AND upper(trim(product_code)) NOT IN ('', 'NAN')""",
    "catalogue_names": """SELECT code, name FROM (SELECT code, name,
          row_number() OVER (PARTITION BY code ORDER BY n DESC, first_place) AS r
        FROM (SELECT code, name, count(*) AS n, min(place) AS first_place FROM (
            SELECT code, name, row_number() OVER (ORDER BY source, invoice_no NULLS FIRST,
              quantity NULLS FIRST, invoice_date NULLS FIRST, unit_price NULLS FIRST,
              customer_id NULLS FIRST, country NULLS FIRST) AS place FROM catalogue_lines)
          WHERE name IS NOT NULL GROUP BY code, name)) WHERE r = 1""",
    "catalogue": f"""SELECT n.code, n.name, {_case('n.name', CATALOGUE_KEYWORDS)} AS category,
        'United Kingdom' AS supplier_country,
        coalesce(s.last_ts >= (SELECT max(ts) FROM catalogue_lines) - INTERVAL 180 DAYS, false) AS is_active
        FROM catalogue_names n JOIN (SELECT code, max(ts) AS last_ts FROM catalogue_lines GROUP BY code) s
        ON n.code = s.code""",
    "variants": """SELECT product_code, count(DISTINCT description) AS variants FROM text1
        WHERE product_code IS NOT NULL GROUP BY product_code""",
    "numbers": """SELECT source, quantity, unit_price, try_cast(quantity AS DOUBLE) AS q,
        try_cast(unit_price AS DOUBLE) AS p FROM texts""",
    "clipped": """SELECT source, CASE WHEN q > 0 THEN 'sale' ELSE 'return' END AS kind,
        greatest(-100, least(200, q)) AS q FROM numbers WHERE q IS NOT NULL""",
    "ends": """SELECT source, kind, CASE WHEN min(q) = max(q) THEN min(q) - 0.5 ELSE min(q) END AS lo,
        CASE WHEN min(q) = max(q) THEN max(q) + 0.5 ELSE max(q) END AS hi,
        CASE WHEN kind = 'sale' THEN 50 ELSE 20 END AS bins FROM clipped GROUP BY source, kind""",
}
for _name in ("catalogue_lines", "catalogue_names", "catalogue"):
    _CTES[_name.replace("catalogue", "catalogue2")] = _CTES[_name].replace("catalogue", "catalogue2")
_CTES["catalogue2_lines"] += " AND source = 'source2'"
_WITH = "WITH " + ",\n".join(f"{name} AS ({text.strip()})" for name, text in _CTES.items()) + "\n"

_PRODUCT_COLUMNS = "product_code, canonical_name, category"
_Q1 = f"""SELECT CAST(year AS INT) AS year, CAST(month AS INT) AS month, month_name, periodo,
    {_money('g')} AS ventas_brutas, {_money('r')} AS devoluciones, {_money('n')} AS ventas_netas,
    {_int('sales')} AS num_transacciones_venta, {_int('backs')} AS num_devoluciones,
    {_pct('r', 'g')} AS pct_devolucion FROM months ORDER BY year, month"""
_Q4 = f"""SELECT country, inv AS num_facturas, lines AS num_lineas_venta,
    {_money('rev')} AS revenue_bruto_total, {_ratio('rev', 'inv')} AS ticket_promedio_por_factura,
    {_pct('rev', '(SELECT sum(rev) FROM per_country)')} AS pct_del_total_revenue
    FROM per_country ORDER BY revenue_bruto_total DESC, country LIMIT {{}}"""
_Q5 = f"""SELECT {{}} CASE WHEN is_anonymous THEN 'Sin cliente' ELSE 'Identificado' END AS tipo_cliente,
    cust AS num_clientes, inv AS num_facturas, lines AS num_lineas, {_money('rev')} AS revenue_bruto,
    {_ratio('rev', 'inv')} AS ticket_promedio, {_ratio('inv', 'cust')} AS facturas_por_cliente
    FROM per_type ORDER BY is_anonymous"""
_Q7 = f"""SELECT {_PRODUCT_COLUMNS}, {_money('g')} AS revenue_bruto, {_money('r')} AS monto_devuelto,
    {_money('n')} AS revenue_neto, {_int('sales')} AS num_ventas, {_int('backs')} AS num_devoluciones,
    CAST(ROUND(rate, 2) AS DECIMAL(38,2)) AS tasa_devolucion_pct {{}} FROM critical
    ORDER BY revenue_bruto DESC, product_code {{}}"""
_FACT_COLUMNS = """invoice_no, product_code, customer_id,
    strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_date, date_id, quantity,
    CAST(unit_price AS DECIMAL(38,4)) AS unit_price, CAST(gross_revenue AS DECIMAL(38,4)) AS gross_revenue,
    country, transaction_type, source, source_row_hash"""
_DAILY_COLUMNS = f"""date_id, product_code, country, CAST(gross_sales AS DECIMAL(38,4)) AS gross_sales,
    CAST(total_returns AS DECIMAL(38,4)) AS total_returns, CAST(net_revenue AS DECIMAL(38,4)) AS net_revenue,
    {_int('sale_quantity')} AS sale_quantity, {_int('return_quantity')} AS return_quantity,
    sale_count, return_count"""
_ORDERED_TEXT = ("ORDER BY invoice_no NULLS LAST, product_code NULLS LAST, description NULLS LAST, "
                 "quantity NULLS LAST, invoice_date NULLS LAST, unit_price NULLS LAST, "
                 "customer_id NULLS LAST, country NULLS LAST")
_TABLES = {"dim_products": "products", "dim_customers": "customers", "dim_date": "calendar",
           "fact_transactions": "facts", "fact_daily_revenue": "daily", "log_rejected_records": "log",
           "log_pipeline_runs": "runs"}


def _change(distance: int, name: str) -> str:
    return f"""SELECT CAST(a.year AS INT) AS year, CAST(a.month AS INT) AS month, {_money('a.n')} AS ventas_netas,
        {_money('b.n')} AS ventas_anteriores, {_pct('(a.n - b.n)', 'b.n')} AS {name}
        FROM months a JOIN months b ON a.year * 12 + a.month = b.year * 12 + b.month + {distance}"""


def _nulls() -> str:
    columns = ["invoice_no", "product_code", "description", "quantity", "invoice_date", "unit_price",
               "customer_id", "country"]
    return "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT source, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
        CAST(round_even(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) AS DECIMAL(38,2)) AS pct
        FROM texts GROUP BY source""" for c in columns) + ") WHERE nulls > 0"


def _shape(name: str, cte: str, headers: list[str], other: list[str]) -> str:
    return f"""SELECT '{name}' AS source, count(*) AS n_rows, CAST({len(headers)} AS BIGINT) AS n_columns,
        '{", ".join(headers)}' AS column_names, '{", ".join(["string"] * len(headers))}' AS column_types,
        '{", ".join(h for h in headers if h not in other)}' AS only_here FROM {cte}"""


_HEADERS1 = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID",
             "Country"]
_HEADERS2 = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID",
             "Country"]


def oracle_sql() -> dict[str, str]:
    canonical = f"SELECT {_LINE_COLUMNS} FROM combined WHERE source = '{{}}'"
    category = "SELECT product_code, canonical_name, {} AS category FROM {}"
    bodies = {
        # sources and ingestion
        "src1_canonical": canonical.format("source1"),
        "src2_canonical": canonical.format("source2"),
        "yearly_union": """SELECT CAST(dense_rank() OVER (ORDER BY sheet_year NULLS LAST) - 1 AS INT) AS sheet, sheet_year,
            count(*) AS n_lines, min(invoice_date) AS first_date, max(invoice_date) AS last_date FROM (
              SELECT invoice_date, CAST(substr(invoice_date, 1, 4) AS INT) AS sheet_year
              FROM combined WHERE source = 'source2') GROUP BY sheet_year""",
        "csv_roundtrip": f"""SELECT * REPLACE (CASE WHEN product_code LIKE '%7' THEN 'a "b", ' || description || chr(10) || 'c'
              WHEN product_code LIKE '%5' THEN NULL ELSE description END AS description)
            FROM (SELECT {_LINE_COLUMNS} FROM combined)""",
        "mixed_date_layouts": """SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 7 IN (4, 5) THEN CAST(o_orderdate AS TIMESTAMP)
            ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END, '%Y-%m-%d %H:%M:%S') AS iso_date FROM orders""",
        "keyword_file": category.format(_case("canonical_name", KEYWORDS), "names"),
        "catalog_file": "SELECT * FROM catalogue",
        "append_facts": f"SELECT {_FACT_COLUMNS}, strftime(date_id, '%Y-%m') AS month FROM facts",
        "revenue_invariant": """SELECT unnest(['months', 'categories', 'customer types', 'lines']) AS "grouping", gross_sales FROM (
            SELECT CAST(sum(gross_revenue) AS DECIMAL(38,4)) AS gross_sales FROM facts WHERE transaction_type = 'SALE')""",
        "parse_dates_by_source": f"""SELECT source, invoice_date AS date_text,
            {_TS.format(_PARSE.format('invoice_date'))} AS iso_date, count(*) AS n_lines FROM texts GROUP BY 1, 2, 3""",
        "combine_sources": f"SELECT {_LINE_COLUMNS}, CAST(CASE WHEN source = 'source2' THEN 0 ELSE 1 END AS INT) AS source_priority FROM combined",
        "dedup_keep_first": f"SELECT {_LINE_COLUMNS} FROM ranked WHERE rn = 1",
        "duplicates_log": f"SELECT {_LINE_COLUMNS}, 'Duplicado' AS rejection_reason FROM ranked WHERE rn > 1",
        "dedup_counts": """SELECT count(*) AS lines_before, count(*) FILTER (WHERE rn > 1) AS lines_removed,
            count(*) FILTER (WHERE rn = 1) AS lines_unique FROM ranked""",
        # cleaning
        "coerce_numeric": """SELECT quantity AS quantity_text, try_cast(quantity AS DOUBLE) AS quantity,
            unit_price AS unit_price_text, try_cast(unit_price AS DOUBLE) AS unit_price, count(*) AS n_lines
            FROM ranked WHERE rn = 1 GROUP BY 1, 2, 3, 4""",
        "reject_non_numeric": """SELECT invoice_no, raw_code AS product_code, source FROM checked
            WHERE reason = 'quantity o unit_price no es numerico'""",
        "reject_blank_code": "SELECT invoice_no, raw_description AS description, source FROM checked WHERE reason = 'product_code nulo o vacio'",
        "fill_description": """SELECT c.invoice_no, c.code_key, upper(coalesce(c.description, f.fill_name, 'SIN DESCRIPCION')) AS description,
            c.source FROM past_code c LEFT JOIN fill f ON c.code_key = f.code_key""",
        "upper_description": "SELECT raw_description, upper(description) AS description, count(*) AS n_lines FROM cleaned GROUP BY 1, 2",
        "normalize_codes": "SELECT raw_code, code_key, product_code, count(*) AS n_lines FROM cleaned GROUP BY 1, 2, 3",
        "normalize_dates": f"SELECT invoice_date, {_UTC} AS invoice_date_utc, date_id, count(*) AS n_lines FROM typed GROUP BY 1, 2, 3",
        "assign_category_keyword": category.format(_case("canonical_name", KEYWORDS), "names"),
        "assign_category_keyword_default_map": category.format(_case("canonical_name", PIPELINE_KEYWORDS), "names"),
        "assign_category_catalog": """SELECT n.product_code, n.canonical_name, coalesce(c.category, 'Varios') AS category
            FROM names n LEFT JOIN catalogue c ON n.product_code = c.code""",
        "assign_category": f"""SELECT 'catalogue' AS mode, n.product_code, coalesce(c.category, 'Varios') AS category
            FROM names n LEFT JOIN catalogue c ON n.product_code = c.code
            UNION ALL SELECT 'keywords', product_code, {_case('canonical_name', KEYWORDS)} FROM names""",
        "normalize_customer": "SELECT raw_customer, customer_id, count(*) AS n_lines FROM cleaned GROUP BY 1, 2",
        "tag_transaction_type": "SELECT CAST(quantity AS BIGINT) AS quantity, transaction_type, count(*) AS n_lines FROM typed GROUP BY 1, 2",
        "count_by_type": "SELECT transaction_type, count(*) AS n FROM past_date GROUP BY 1",
        "reject_bad_price": "SELECT invoice_no, product_code, CAST(quantity AS BIGINT) AS quantity, source FROM checked WHERE reason = 'Precio Unitario <=0'",
        "gross_revenue": "SELECT invoice_no, product_code, CAST(quantity AS BIGINT) AS quantity, CAST(gross_revenue AS DECIMAL(38,4)) AS gross_revenue, source FROM valid",
        "canonical_name": "SELECT v.invoice_no, v.product_code, n.canonical_name, v.source FROM valid v JOIN names n ON v.product_code = n.product_code",
        "mode_per_group": "SELECT code_key, fill_name FROM fill",
        "row_hash": "SELECT invoice_no, product_code, source, source_row_hash FROM hashed",
        "fill_country": "SELECT country, count(*) AS n_lines FROM valid GROUP BY 1",
        "cut_quantities": "SELECT count(*) FILTER (WHERE quantity <> floor(quantity)) AS cut_quantities FROM valid",
        "run_transformation": """SELECT 'valid' AS output, source_row_hash AS key,
              concat_ws('|', coalesce(invoice_no, ''), customer_id, transaction_type, country) AS content FROM hashed
            UNION ALL SELECT 'products', product_code, concat_ws('|', canonical_name, category) FROM products
            UNION ALL SELECT 'customers', customer_id, CAST(is_anonymous AS VARCHAR) FROM customers
            UNION ALL SELECT 'rejected', rejection_reason, concat_ws('|', coalesce(invoice_no, ''), coalesce(product_code, ''),
              coalesce(description, ''), source) FROM rejected""",
        # rejects, counters, run log
        "rejected_rows": f"SELECT {_LINE_COLUMNS}, rejection_reason, transaction_type, invoice_date_utc, date_id FROM rejected",
        "rejects_by_reason": "SELECT rejection_reason, count(*) AS n FROM rejected GROUP BY 1 ORDER BY n DESC, 1",
        "reject_log_json": "SELECT * FROM log",
        "run_log": "SELECT * FROM runs",
        "pipeline_counts": """SELECT (SELECT count(*) FROM valid) AS records_valid,
            (SELECT count(*) FROM rejected) AS records_rejected, (SELECT count(*) FROM products) AS products_count""",
        "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {c}"
                                           for t, c in _TABLES.items() if t != "dim_date"),
        "anonymous_impact": "SELECT count(*) FILTER (WHERE customer_id = 'ANONYMOUS') AS anonymous_lines FROM past_date",
        "null_description_impact": "SELECT count(*) FILTER (WHERE description IS NULL) AS repaired_descriptions FROM past_code",
        # dimensions and facts
        "dim_products": "SELECT * FROM products",
        "dim_customers": """SELECT c.customer_id, c.is_anonymous, min(f.date_id) AS first_seen_at,
            max(f.date_id) AS last_seen_at FROM customers c JOIN facts f ON c.customer_id = f.customer_id GROUP BY 1, 2""",
        "dim_date": "SELECT c.*, (SELECT count(*) FROM facts f WHERE f.date_id = c.date_id) AS n_lines FROM calendar c",
        "anonymous_seed": f"""SELECT customer_id, is_anonymous, NULL::DATE AS first_seen_at, NULL::DATE AS last_seen_at FROM customers
            WHERE NOT is_anonymous UNION ALL SELECT 'ANONYMOUS', true, DATE '{FIRST_DAY}', DATE '{LAST_DAY}'""",
        "fact_transactions": f"SELECT {_FACT_COLUMNS} FROM facts",
        "daily_revenue": f"SELECT {_DAILY_COLUMNS} FROM daily",
        "upsert_products": f"""SELECT product_code, CASE WHEN b OR NOT a THEN canonical_name ELSE 'OLD NAME' END AS canonical_name,
            CASE WHEN b OR NOT a THEN {_case('canonical_name', KEYWORDS)} ELSE 'OLD' END AS category,
            true AS is_active, a AS was_known, b OR NOT a AS was_updated
            FROM (SELECT *, CAST(substr(product_code, 2) AS BIGINT) % 3 <> 0 AS a,
                  CAST(substr(product_code, 2) AS BIGINT) % 3 <> 1 AS b FROM names)""",
        "insert_customers": """SELECT customer_id, is_anonymous, CASE WHEN try_cast(customer_id AS BIGINT) % 2 = 0
            THEN DATE '1995-01-01' END AS first_seen_at FROM customers""",
        "insert_transactions": """SELECT transaction_type, (SELECT count(*) FROM hashed h WHERE h.transaction_type = f.transaction_type) AS incoming,
            count(*) FILTER (WHERE year(date_id) > 1997) AS inserted FROM facts f GROUP BY 1""",
        "upsert_daily_revenue": f"""SELECT date_id, product_code, country,
            CASE WHEN year(date_id) < 1998 THEN CAST(-1 AS DECIMAL(38,4)) ELSE CAST(net_revenue AS DECIMAL(38,4)) END AS net_revenue,
            CASE WHEN year(date_id) < 1998 THEN 0 ELSE {_int('sale_count')} END AS sale_count FROM daily""",
        "idempotent_rerun": """SELECT count(*) - count(DISTINCT source_row_hash) AS new_facts, CAST(0 AS BIGINT) AS changed_rollup_rows FROM facts""",
        "rollup_by_deltas": f"""SELECT {_DAILY_COLUMNS}, CAST(CASE WHEN year(date_id) <= 1996 THEN 1
            WHEN year(date_id) <= 1998 THEN 2 ELSE 3 END AS BIGINT) AS load_no FROM daily""",
        "loads_logged": """SELECT run_id, 'SUCCESS' AS status, (SELECT count(*) FROM hashed WHERE year(date_id) BETWEEN seen AND last) AS records_extracted,
            (SELECT count(*) FROM facts WHERE year(date_id) BETWEEN fresh AND last) AS records_loaded,
            (SELECT count(*) FROM rejected) AS records_rejected
            FROM (VALUES ('a', 0, 0, 1996), ('b', 1995, 1997, 1998), ('c', 0, 1999, 9999)) v(run_id, seen, fresh, last)""",
        "unpublished_load": """SELECT seen, CAST(year(date_id) AS INT) AS year, count(*) AS facts, count(*) AS rolled_up
            FROM facts JOIN (VALUES ('while it is not published', 1996), ('after the next load', 9999)) v(seen, last)
            ON year(date_id) <= last GROUP BY seen, year(date_id)""",
        # business questions
        "q1_monthly_net_sales": _Q1,
        "q2_category_revenue": f"""SELECT category, {_money('g')} AS revenue_bruto_total, {_money('r')} AS total_devoluciones,
            {_money('n')} AS revenue_neto_total, {_int('sales')} AS num_ventas, {_int('backs')} AS num_devoluciones,
            {_pct('r', 'g')} AS pct_devolucion, {_pct('g', '(SELECT sum(g) FROM per_category)')} AS pct_del_total_revenue
            FROM per_category ORDER BY revenue_bruto_total DESC, category""",
        "q3a_top_net_revenue": f"""SELECT {_PRODUCT_COLUMNS}, {_money('g')} AS revenue_bruto, {_money('r')} AS devoluciones,
            {_money('n')} AS revenue_neto, {_int('units')} AS unidades_vendidas FROM per_product
            ORDER BY revenue_neto DESC, product_code LIMIT 10""",
        "q3b_top_return_rate": f"""SELECT {_PRODUCT_COLUMNS}, {_int('sales')} AS num_ventas, {_int('backs')} AS num_devoluciones,
            {_money('g')} AS revenue_bruto, {_money('r')} AS monto_devuelto, {_pct('r', 'g')} AS tasa_devolucion_pct
            FROM per_product WHERE sales >= 10 ORDER BY tasa_devolucion_pct DESC NULLS FIRST, product_code LIMIT 10""",
        "q4_countries": _Q4.format(15),
        "q4_countries_top20": _Q4.format(20),
        "q5_anonymous_vs_identified": _Q5.format(""),
        "q4_countries_of_months": _Q4.format(15),
        "q5_customers_of_months": _Q5.format(""),
        "q5_with_flag": _Q5.format("is_anonymous,"),
        "q6a_unique_codes": "SELECT count(DISTINCT product_code) AS total_codigos_unicos FROM products",
        "q6b_undescribed_products": """SELECT p.product_code, p.canonical_name, p.category, count(f.source_row_hash) AS num_transacciones
            FROM products p LEFT JOIN facts f ON p.product_code = f.product_code
            WHERE p.canonical_name = 'SIN DESCRIPCION' OR p.canonical_name IS NULL
            GROUP BY 1, 2, 3 ORDER BY num_transacciones DESC, 1""",
        "q6c_blank_names": """SELECT f.product_code, p.canonical_name AS nombre_canonico, p.category,
            count(DISTINCT f.invoice_no) AS num_transacciones, count(DISTINCT upper(trim(f.product_code))) AS variaciones_codigo
            FROM facts f JOIN (SELECT product_code, nullif(canonical_name, 'SIN DESCRIPCION') AS canonical_name, category
                               FROM products) p ON f.product_code = p.product_code
            WHERE p.canonical_name IS NULL OR p.canonical_name = '' GROUP BY 1, 2, 3 ORDER BY num_transacciones DESC, 1""",
        "q7_recommendation": _Q7.format("", "LIMIT 10"),
        "q7_alerts": _Q7.format(f", '{ALERT_TEXT}' AS alerta", ""),
        # derived metrics
        "yoy_net_growth": _change(12, "crecimiento_pct"),
        "mom_net_change": _change(1, "variacion_pct"),
        "season_share": f"""SELECT CAST(year AS INT) AS year, {_money('sum(CASE WHEN month >= 10 THEN n ELSE 0 END)')} AS temporada,
            {_money('sum(n)')} AS anual, {_pct('sum(CASE WHEN month >= 10 THEN n ELSE 0 END)', 'sum(n)')} AS temporada_pct
            FROM months GROUP BY year""",
        "return_rate_vs_average": f"""SELECT CAST(year AS INT) AS year, CAST(month AS INT) AS month, {_pct('r', 'g')} AS pct_devolucion,
            (SELECT {_pct('sum(r)', 'sum(g)')} FROM months) AS pct_global,
            CAST(ROUND((CAST(r AS DOUBLE) / g) / (SELECT CAST(sum(r) AS DOUBLE) / sum(g) FROM months), 2) AS DECIMAL(38,2)) AS veces
            FROM months""",
        "anonymous_share": f"""SELECT {_pct('max(rev) FILTER (WHERE is_anonymous)', 'sum(rev)')} AS anonimo_pct,
            CAST(ROUND(max(CAST(rev AS DOUBLE) / inv) FILTER (WHERE is_anonymous)
              / max(CAST(rev AS DOUBLE) / inv) FILTER (WHERE NOT is_anonymous), 2) AS DECIMAL(38,2)) AS ticket_veces FROM per_type""",
        "ticket_vs_home": f"""SELECT country, {_ratio('rev', 'inv')} AS ticket_promedio,
            CAST(ROUND((CAST(rev AS DOUBLE) / inv) / (SELECT CAST(rev AS DOUBLE) / inv FROM per_country
              WHERE country = '{HOME_COUNTRY}'), 2) AS DECIMAL(38,2)) AS veces_local FROM per_country""",
        "top_n_net_total": f"""SELECT count(*) AS productos, {_money('sum(n)')} AS revenue_neto
            FROM (SELECT n FROM per_product ORDER BY n DESC, product_code LIMIT 3)""",
        "described_share": f"""SELECT count(*) AS productos, count(*) FILTER (WHERE canonical_name <> 'SIN DESCRIPCION') AS con_descripcion,
            {_pct("count(*) FILTER (WHERE canonical_name <> 'SIN DESCRIPCION')", 'count(*)')} AS con_descripcion_pct FROM products""",
        "category_rate_ratio": f"""SELECT category, {_pct('r', 'g')} AS pct_devolucion,
            CAST(ROUND((CAST(r AS DOUBLE) / g) / (SELECT CAST(r AS DOUBLE) / g FROM per_category WHERE category = 'Table'), 2)
              AS DECIMAL(38,2)) AS veces_base FROM per_category""",
        # integrity
        "fk_orphans": " UNION ALL ".join(
            f"""SELECT '{c}' AS table_name, '{k}' AS key_name, '{p}' AS parent_table, count(*) AS orphan_rows
            FROM {_TABLES[c]} WHERE {k} NOT IN (SELECT {k} FROM {_TABLES[p]})""" for c, k, p in FOREIGN_KEYS),
        "pk_violations": " UNION ALL ".join(
            f"""SELECT '{t}' AS table_name, '{",".join(k)}' AS key_name, count(*) AS repeated_keys
            FROM (SELECT 1 FROM {_TABLES[t]} GROUP BY {", ".join(k)} HAVING count(*) > 1)""" for t, k in PRIMARY_KEYS.items()),
        "domain_violations": "SELECT count(*) AS bad_transaction_types FROM facts WHERE transaction_type NOT IN ('SALE', 'RETURN')",
        "not_null_violations": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {_TABLES[t]}"
            for t, cs in NOT_NULL.items() for c in cs),
        "length_violations": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE length({c}) > {n}) AS violations FROM {_TABLES[t]}"
            for t, cs in MAX_LENGTHS.items() for c, n in cs.items()),
        # profiling
        "profile_shape": _shape("source1", "raw1", _HEADERS1, _HEADERS2) + " UNION ALL "
                         + _shape("source2", "raw2", _HEADERS2, _HEADERS1),
        "profile_sample": f"SELECT {_LINE_COLUMNS} FROM text2 {_ORDERED_TEXT} LIMIT 30",
        "zero_price_sample": f"""SELECT invoice_no, product_code, description, quantity, unit_price FROM text1
            WHERE try_cast(unit_price AS DOUBLE) = 0 {_ORDERED_TEXT} LIMIT 5""",
        "null_report": _nulls(),
        "quantity_profile": f"""SELECT source, count(*) AS total, count(*) FILTER (WHERE q > 0) AS sales,
            {_pct('count(*) FILTER (WHERE q > 0)', 'count(*)', 1)} AS sales_pct, count(*) FILTER (WHERE q <= 0) AS returns,
            {_pct('count(*) FILTER (WHERE q <= 0)', 'count(*)', 1)} AS returns_pct,
            count(*) FILTER (WHERE q IS NULL) AS not_numeric, CAST(round(min(q)) AS BIGINT) AS min_quantity,
            CAST(round(max(q)) AS BIGINT) AS max_quantity FROM numbers GROUP BY source""",
        "quantity_histogram": """SELECT e.source, e.kind, b.bin, CAST(ROUND(lo + b.bin * (hi - lo) / bins, 4) AS DECIMAL(38,4)) AS bin_low,
            CAST(ROUND(lo + (b.bin + 1) * (hi - lo) / bins, 4) AS DECIMAL(38,4)) AS bin_high, count(c.q) AS n_lines
            FROM ends e JOIN (SELECT unnest(range(50)) AS bin) b ON b.bin < e.bins
            LEFT JOIN clipped c ON c.source = e.source AND c.kind = e.kind
              AND least(CAST(floor((c.q - lo) * bins / (hi - lo)) AS BIGINT), bins - 1) = b.bin
            GROUP BY e.source, e.kind, b.bin, lo, hi, bins""",
        "price_profile": """SELECT source, count(*) FILTER (WHERE p = 0) AS zero_prices, count(*) FILTER (WHERE p < 0) AS negative_prices,
            count(*) FILTER (WHERE p IS NULL) AS null_prices, CAST(ROUND(min(p), 4) AS DECIMAL(38,4)) AS min_price,
            CAST(ROUND(max(p), 2) AS DECIMAL(38,2)) AS max_price,
            CAST(ROUND(CAST(sum(CAST(p AS DECIMAL(28,10))) AS DOUBLE) / count(p), 2) AS DECIMAL(38,2)) AS mean_price
            FROM numbers GROUP BY source""",
        "date_profile": f"""SELECT source, (SELECT invoice_date FROM texts b WHERE b.source = a.source {_ORDERED_TEXT} LIMIT 1) AS first_text,
            {_TS.format("min(ts)")} AS first_time, {_TS.format("max(ts)")} AS last_time, count(*) FILTER (WHERE ts IS NULL) AS invalid_dates
            FROM (SELECT source, {_PARSE.format('invoice_date')} AS ts FROM texts) a GROUP BY source""",
        "source_overlap": f"""SELECT CAST(max(ts) FILTER (WHERE source = 'source1') AS DATE) AS source1_ends,
            CAST(min(ts) FILTER (WHERE source = 'source2') AS DATE) AS source2_starts
            FROM (SELECT source, {_PARSE.format('invoice_date')} AS ts FROM texts)""",
        "monthly_counts": f"""SELECT source, CAST(date_trunc('month', {_PARSE.format('invoice_date')}) AS DATE) AS month, count(*) AS n_lines
            FROM texts WHERE {_PARSE.format('invoice_date')} IS NOT NULL GROUP BY 1, 2""",
        "customer_profile": f"""SELECT source, count(*) FILTER (WHERE customer_id IS NULL) AS missing_customers,
            {_pct('count(*) FILTER (WHERE customer_id IS NULL)', 'count(*)', 1)} AS missing_pct,
            count(DISTINCT customer_id) AS distinct_customers FROM texts GROUP BY source""",
        "description_variants": "SELECT * FROM variants",
        "most_varied_codes": "SELECT * FROM variants ORDER BY variants DESC, product_code LIMIT 5",
        "variant_summary": "SELECT count(*) AS product_codes, count(*) FILTER (WHERE variants > 1) AS codes_with_variants FROM variants",
        "variants_of_top_code": """SELECT product_code, description, count(*) AS n FROM text1 WHERE description IS NOT NULL
            AND product_code = (SELECT product_code FROM variants ORDER BY variants DESC, product_code LIMIT 1)
            GROUP BY 1, 2 ORDER BY n DESC, description LIMIT 8""",
        "nonnumeric_codes": """SELECT product_code AS example, count(*) AS n,
            CAST((SELECT count(*) FROM text1 WHERE NOT coalesce(regexp_matches(product_code, '^[0-9]'), false)) AS BIGINT) AS nonnumeric_lines
            FROM text1 WHERE NOT coalesce(regexp_matches(product_code, '^[0-9]'), false)
            GROUP BY 1 ORDER BY product_code NULLS FIRST LIMIT 10""",
        "duplicate_profile": f"""SELECT source, {_int('sum(n - 1)')} AS duplicates FROM (SELECT source, count(*) AS n FROM texts
            GROUP BY source, invoice_no, product_code, quantity, invoice_date) GROUP BY source""",
        "overlapping_invoices": """SELECT count(*) AS overlapping_invoices FROM (SELECT invoice_no FROM text1 WHERE invoice_no IS NOT NULL
            INTERSECT SELECT invoice_no FROM text2)""",
        "country_profile": """SELECT country, count(*) AS n_lines, CAST((SELECT count(DISTINCT country) FROM text1) AS BIGINT) AS distinct_countries
            FROM text1 WHERE country IS NOT NULL GROUP BY country ORDER BY n_lines DESC, country LIMIT 10""",
        # catalogue
        "build_catalog": "SELECT * FROM catalogue",
        "build_catalog_source2": "SELECT * FROM catalogue2",
        "catalog_active": "SELECT is_active, count(*) AS products FROM catalogue GROUP BY 1",
        "catalog_category": "SELECT category, count(*) AS products FROM catalogue GROUP BY 1",
        "catalog_page": "SELECT * FROM catalogue WHERE lower(category) = 'varios' AND is_active ORDER BY code LIMIT 50 OFFSET 50",
        "catalog_page_deep": "SELECT * FROM catalogue ORDER BY code LIMIT 200 OFFSET 400",
        "catalog_page_summary": """SELECT total, CAST(2 AS BIGINT) AS page, CAST(50 AS BIGINT) AS size,
            greatest(1, CAST(ceil(total / 50) AS BIGINT)) AS pages
            FROM (SELECT count(*) AS total FROM catalogue WHERE lower(category) = 'varios' AND is_active)""",
        "catalog_lookup": "SELECT * FROM catalogue WHERE code = 'P17'",
    }
    return {name: _WITH + body for name, body in bodies.items()}
