"""The queries as SQL for DuckDB, written against the driver's tables.

Each statement builds the same sales-shaped inputs as `inputs.py` in CTEs and then states
the operator in SQL. Neither logic nor patterns are shared with the engine. Ids are the
`wide` ones of `inputs.py`, and so are the patterns, or the short ones, whose ids repeat.
"""

from __future__ import annotations

# What ids, contact data and dates must look like, and what names lose.
_ORDER = "^[A-Z]{2}-[0-9]{4}-[0-9]{6}$"
_CUSTOMER = "^[A-Z]{2}-[0-9]{5}$"
_PRODUCT = "^[A-Z]{3}-[A-Z]{2}-[0-9]{8}$"
_WIDE_CUSTOMER = "^[A-Z]{2}-[0-9]{5,}$"
_WIDE_PRODUCT = "^[A-Z]{3}-[A-Z]{2}-[0-9]{8,}$"
_EMAIL = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$"
_PHONE = "^([+]1[[:space:]]?)?[(]?[0-9]{3}[)]?[[:space:].-]?[0-9]{3}[[:space:].-]?[0-9]{4}$"
_POSTAL = "^[0-9]{5}(-[0-9]{4})?$"
_TWO_DIGIT_DATE = "^[0-9]{2}/[0-9]{2}/[0-9]{4}$"
_SHORT_DATE = "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
_NOT_LETTER = "[^a-zA-Z[:space:]]"
_NOT_ASCII = "[^[:ascii:]]"


def _code(prefix: str, key: str, span: int, digits: int, wide: bool) -> str:
    """A keyed id: two letters for the span number, then digits with zeros in front."""
    at = f"({key} // {span}) % 676"
    number = f"{key} % {span}"
    if wide:
        number += f" + ({key} // {676 * span}) * {span}"
    text = f"CAST({number} AS VARCHAR)"
    return (
        f"'{prefix}' || chr(CAST(65 + ({at}) // 26 AS INTEGER))"
        f" || chr(CAST(65 + ({at}) % 26 AS INTEGER)) || '-'"
        f" || lpad({text}, CAST(greatest({digits}, length({text})) AS INTEGER), '0')"
    )


def _customer_code(key: str, wide: bool) -> str:
    return _code("", f"CAST({key} AS BIGINT)", 100_000, 5, wide)


def _product_code(key: str, wide: bool) -> str:
    return _code("FUR-", f"CAST({key} AS BIGINT)", 100_000_000, 8, wide)


_ROW_ID = "CAST((l_orderkey * 8 + l_linenumber) % 2147483647 AS INTEGER) AS row_id"
_ORDER_ID = (
    "'CA-' || CAST(year(o_orderdate) AS VARCHAR) || '-'"
    " || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0')"
)
_MEASURES = """CAST(l_quantity AS INTEGER) AS quantity,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
    CAST(l_discount AS DECIMAL(5,2)) AS discount,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
      AS DECIMAL(10,2)) AS profit"""


def _planted_date(key: str, date: str) -> str:
    return (
        f"CASE WHEN {key} % 11 = 0 THEN '31/02/2016'"
        f" WHEN {key} % 13 = 0 THEN strftime({date}, '%-d/%-m/%Y')"
        f" ELSE strftime({date}, '%d/%m/%Y') END"
    )


def _parsed(column: str, form: str = "%d/%m/%Y", shape: str = _TWO_DIGIT_DATE) -> str:
    return (
        f"CASE WHEN regexp_matches({column}, '{shape}')"
        f" THEN CAST(try_strptime({column}, '{form}') AS DATE) END AS {column}"
    )


_FOUR = "lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')"
_FIVE = "lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')"
_KEY = "CAST(c_custkey AS VARCHAR)"


def _kept(column: str, pattern: str) -> str:
    return f"CASE WHEN regexp_matches({column}, '{pattern}') THEN {column} END AS {column}"


def _ctes(wide: bool) -> dict[str, str]:
    customer, product = (
        (_WIDE_CUSTOMER, _WIDE_PRODUCT) if wide else (_CUSTOMER, _PRODUCT)
    )
    return {
        "orders_in": f"""
  SELECT {_ROW_ID}, {_ORDER_ID} AS order_id,
    CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
    o_orderpriority AS ship_mode, o_custkey AS customer_id, l_partkey AS product_id,
    {_MEASURES}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "customers_in": """
  SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "products_in": """
  SELECT p_partkey AS product_id, p_type AS category, p_brand AS subcategory,
    p_name AS product_name
  FROM part""",
        "joined": """
  SELECT row_id, order_id, order_date, ship_date, ship_mode, quantity, price, discount,
    profit, customer_name, country, category AS product_category,
    subcategory AS product_sub_category
  FROM orders_in JOIN customers_in USING (customer_id) JOIN products_in USING (product_id)""",
        "summary": """
  SELECT CAST(year(order_date) AS INTEGER) AS year, product_category, product_sub_category,
    customer_name, CAST(SUM(profit) AS DECIMAL(20,2)) AS total_profit
  FROM joined GROUP BY ALL""",
        "raw_orders": f"""
  SELECT {_ROW_ID},
    CASE WHEN o_orderkey % 17 = 0 THEN 'BAD' ELSE {_ORDER_ID} END AS order_id,
    {_planted_date("o_orderkey", "o_orderdate")} AS order_date,
    {_planted_date("l_suppkey", "l_shipdate")} AS ship_date,
    o_orderpriority AS ship_mode,
    CASE WHEN o_orderkey % 23 <> 0 THEN {_customer_code("o_custkey", wide)} END AS customer_id,
    {_product_code("l_partkey", wide)} AS product_id,
    {_MEASURES}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "raw_customers": f"""
  SELECT CASE WHEN c_custkey % 19 = 0 THEN 'BAD-' || {_KEY}
      WHEN c_custkey % 29 <> 0 THEN {_customer_code("c_custkey", wide)} END AS customer_id,
    translate(c_name, '0123456789', 'ABCDEFGHIJ')
      || CASE WHEN c_custkey % 4 = 0 THEN '-José 3' ELSE '' END AS customer_name,
    CASE c_custkey % 5 WHEN 0 THEN 'user' || {_KEY} || '@mail'
      WHEN 1 THEN 'user.' || {_KEY} || '@mail.example.com' WHEN 2 THEN NULL
      WHEN 3 THEN '#ERROR!' ELSE 'u_' || {_KEY} || '+x@example.org' END AS email,
    CASE c_custkey % 8 WHEN 0 THEN '421.580.0902x9815' WHEN 1 THEN '#ERROR!'
      WHEN 2 THEN '(123) 456-' || {_FOUR} WHEN 3 THEN '+1 123-456-' || {_FOUR}
      WHEN 4 THEN '123.456.' || {_FOUR} WHEN 5 THEN '12345' WHEN 6 THEN NULL
      ELSE '+1(123)456-' || {_FOUR} END AS phone,
    'No ' || {_KEY} || ' Main Street' AS address,
    c_mktsegment AS segment, n_name AS country,
    'City ' || CAST(c_custkey % 100 AS VARCHAR) AS city,
    'State ' || CAST(c_custkey % 50 AS VARCHAR) AS state,
    CASE c_custkey % 6 WHEN 0 THEN '1234' WHEN 1 THEN {_FIVE} || '-6789'
      WHEN 2 THEN '12345.0' WHEN 3 THEN NULL ELSE {_FIVE} END AS postal_code,
    r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""",
        "raw_products": f"""
  SELECT CASE WHEN p_partkey % 19 = 0 THEN 'BAD' ELSE {_product_code("p_partkey", wide)} END
      AS product_id,
    p_type AS category, p_brand AS subcategory,
    p_name || CASE WHEN p_partkey % 3 = 0 THEN ' José-3 ®' ELSE '' END AS product_name,
    'State ' || CAST(p_partkey % 50 AS VARCHAR) AS state,
    CAST(p_retailprice AS DECIMAL(10,2)) AS price_per_product
  FROM part""",
        "valid_orders": f"""
  SELECT * FROM raw_orders
  WHERE regexp_matches(order_id, '{_ORDER}')
    AND regexp_matches(customer_id, '{customer}')
    AND regexp_matches(product_id, '{product}')""",
        "clean_orders": f"""
  SELECT * REPLACE ({_parsed("order_date")}, {_parsed("ship_date")}) FROM valid_orders""",
        "clean_customers": f"""
  SELECT * REPLACE (
      regexp_replace(customer_name, '{_NOT_LETTER}', '', 'g') AS customer_name,
      {_kept("email", _EMAIL)}, {_kept("phone", _PHONE)},
      {_kept("postal_code", _POSTAL)})
  FROM raw_customers WHERE regexp_matches(customer_id, '{customer}')""",
        "clean_products": f"""
  SELECT * REPLACE (
      regexp_replace(product_name, '{_NOT_ASCII}', '', 'g') AS product_name)
  FROM raw_products WHERE regexp_matches(product_id, '{product}')""",
        "clean_sales": """
  SELECT o.*, c.customer_name, c.country, p.category AS product_category,
    p.subcategory AS product_sub_category
  FROM clean_orders o JOIN clean_customers c ON o.customer_id = c.customer_id
    JOIN clean_products p ON o.product_id = p.product_id""",
        "clean_summary": """
  SELECT CAST(year(order_date) AS INTEGER) AS year, product_category, product_sub_category,
    customer_name, CAST(SUM(profit) AS DECIMAL(20,2)) AS total_profit
  FROM clean_sales GROUP BY ALL""",
        "dated_sales": """
  SELECT CAST(year(CASE WHEN ship_mode <> '5-LOW' THEN order_date END) AS INTEGER) AS year,
    category AS product_category, subcategory AS product_sub_category,
    c_name AS customer_name, ship_date, profit
  FROM orders_in JOIN customer ON customer_id = c_custkey JOIN products_in USING (product_id)""",
        "earlier": """
  SELECT year, product_category, product_sub_category, customer_name,
    CAST(SUM(profit) AS DECIMAL(20,2)) AS total_profit
  FROM dated_sales WHERE ship_date < DATE '1999-01-01' GROUP BY ALL""",
        "later": """
  SELECT year, product_category, product_sub_category, customer_name,
    CAST(SUM(profit) AS DECIMAL(20,2)) AS total_profit
  FROM dated_sales WHERE ship_date >= DATE '1997-01-01' GROUP BY ALL""",
    }


_CLEAN = ("raw_orders", "raw_customers", "raw_products", "valid_orders", "clean_orders",
          "clean_customers", "clean_products", "clean_sales")
_NATURAL = ("orders_in", "customers_in", "products_in", "joined")
_BATCHES = ("orders_in", "products_in", "dated_sales", "earlier", "later")


def _sql(names: tuple[str, ...], body: str, wide: bool = False) -> str:
    ctes = _ctes(wide)
    return "WITH " + ",\n".join(f"{name} AS ({ctes[name]})" for name in names) + "\n" + body


def _report(ctes: tuple[str, ...], keys: str, total: str) -> str:
    return _sql(
        ctes,
        f"SELECT {keys}, CAST(SUM(total_profit) AS DECIMAL(30,2)) AS {total}"
        f" FROM {ctes[-1]} GROUP BY {keys} ORDER BY {keys}",
    )


def _merged(same: str) -> str:
    """A full outer join with a presence flag per side; `same` compares two keys."""
    keys = ("year", "product_category", "product_sub_category", "customer_name")
    on = " AND ".join(f"e.{key} {same} n.{key}" for key in keys)
    pick = ", ".join(
        f"CASE WHEN e.here IS NULL THEN n.{key} ELSE e.{key} END AS {key}" for key in keys
    )
    return _sql(
        _BATCHES,
        f"""SELECT {pick},
  CASE WHEN e.here IS NULL THEN n.total_profit
    WHEN n.here IS NOT NULL AND e.total_profit <> n.total_profit THEN n.total_profit
    ELSE e.total_profit END AS total_profit,
  CASE WHEN e.here IS NULL THEN 'inserted'
    WHEN n.here IS NOT NULL AND e.total_profit <> n.total_profit THEN 'updated'
    ELSE 'kept' END AS merge_action
FROM (SELECT *, 1 AS here FROM earlier) e
  FULL OUTER JOIN (SELECT *, 1 AS here FROM later) n ON {on}""",
    )


def _counts(
    ctes: tuple[str, ...], label: str, parts: dict[str, str], wide: bool = False
) -> str:
    return _sql(
        ctes,
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS {label}, "
            + (f"COUNT(*) AS row_count FROM {source}" if source else "0 AS row_count")
            for name, source in parts.items()
        ),
        wide,
    )


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    summary = (*_NATURAL, "summary")
    null_safe = _merged("IS NOT DISTINCT FROM")
    dates = "SELECT row_id, {}, {} FROM raw_orders"
    products_text = (
        "SELECT * REPLACE (CAST(price_per_product AS VARCHAR) AS price_per_product)"
        " FROM raw_products"
    )
    final_summary = _sql((*_CLEAN, "clean_summary"), "SELECT * FROM clean_summary", True)
    return {
        "sales_summary": _sql(summary, "SELECT * FROM summary"),
        "profit_by_year": _report(summary, "year", "total_profit_by_year"),
        "profit_by_year_category": _report(
            summary, "year, product_category", "total_profit_by_year_and_category"
        ),
        "profit_by_customer": _report(summary, "customer_name", "total_profit_by_customer"),
        "profit_by_customer_year": _report(
            summary, "customer_name, year", "total_profit_by_customer_and_year"
        ),
        "profit_by_customer_year_ranked": (
            "SELECT *, row_number() OVER (ORDER BY customer_name NULLS FIRST, year NULLS FIRST)"
            " AS place FROM (" + _report(
                summary, "customer_name, year", "total_profit_by_customer_and_year"
            ) + ") AS report"
        ),
        "orders_with_customers": _sql(
            ("orders_in", "customers_in"),
            "SELECT row_id, order_id, customer_id, customer_name, country"
            " FROM orders_in JOIN customers_in USING (customer_id)",
        ),
        "orders_with_products": _sql(
            ("orders_in", "products_in"),
            "SELECT row_id, order_id, product_id, category, subcategory"
            " FROM orders_in JOIN products_in USING (product_id)",
        ),
        "transactions": _sql(
            _NATURAL,
            "SELECT *, DATE '2020-01-01' AS created_dt, 'system_user' AS created_by,"
            " DATE '2020-01-01' AS updated_dt, 'system_user' AS updated_by FROM joined",
        ),
        "standardize_names": _sql(("raw_products",), "SELECT * FROM raw_products"),
        "audit_columns": _sql(
            ("products_in",),
            "SELECT *, DATE '2020-01-01' AS created_dt, 'system_user' AS created_by"
            " FROM products_in",
        ),
        "conform_types": """SELECT
  CAST((l_orderkey * 8 + l_linenumber) % 2147483647 AS INTEGER) AS row_id,
  CAST(l_orderkey AS VARCHAR) AS order_id, CAST(NULL AS DATE) AS order_date,
  CAST(l_shipdate AS DATE) AS ship_date, CAST(NULL AS VARCHAR) AS ship_mode,
  TRY_CAST(CASE WHEN l_suppkey % 7 = 0 THEN 'n/a'
    ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS INTEGER) AS quantity,
  TRY_CAST(CASE WHEN l_suppkey % 5 = 0 THEN '123456789012.00'
    ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || '5' END
    AS DECIMAL(10,2)) AS price,
  TRY_CAST(CASE WHEN l_suppkey % 3 = 0 THEN ''
    ELSE CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) END AS DECIMAL(5,2)) AS discount,
  CAST(NULL AS DECIMAL(10,2)) AS profit, CAST(NULL AS VARCHAR) AS customer_name,
  CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS product_category,
  CAST(NULL AS VARCHAR) AS product_sub_category,
  CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS created_dt,
  CAST(NULL AS VARCHAR) AS created_by, CAST(NULL AS TIMESTAMP) AS updated_dt,
  CAST(NULL AS VARCHAR) AS updated_by
FROM lineitem""",
        "orders_valid_ids": _sql(
            ("raw_orders", "valid_orders"),
            "SELECT row_id, order_id, customer_id, product_id FROM valid_orders",
        ),
        "orders_rejected": _sql(
            ("raw_orders",),
            f"""SELECT row_id, order_id, customer_id, product_id, order_date, ship_date,
  concat_ws(',',
    CASE WHEN regexp_matches(order_id, '{_ORDER}') THEN NULL ELSE 'order_id' END,
    CASE WHEN regexp_matches(customer_id, '{_CUSTOMER}') THEN NULL ELSE 'customer_id' END,
    CASE WHEN regexp_matches(product_id, '{_PRODUCT}') THEN NULL ELSE 'product_id' END) AS failed
FROM raw_orders
WHERE coalesce(NOT (regexp_matches(order_id, '{_ORDER}')
  AND regexp_matches(customer_id, '{_CUSTOMER}') AND regexp_matches(product_id, '{_PRODUCT}')),
  TRUE)""",
        ),
        "orders_parsed_dates": _sql(
            ("raw_orders",), dates.format(_parsed("order_date"), _parsed("ship_date"))
        ),
        "orders_parsed_dates_relaxed": _sql(
            ("raw_orders",),
            dates.format(
                _parsed("order_date", shape=_SHORT_DATE),
                _parsed("ship_date", shape=_SHORT_DATE),
            ),
        ),
        "orders_parsed_dates_month_first": _sql(
            ("raw_orders",),
            dates.format(_parsed("order_date", "%m/%d/%Y"), _parsed("ship_date", "%m/%d/%Y")),
        ),
        "orders_clean": _sql(
            ("raw_orders", "valid_orders", "clean_orders"), "SELECT * FROM clean_orders"
        ),
        "customers_clean": _sql(
            ("raw_customers", "clean_customers"), "SELECT * FROM clean_customers"
        ),
        "products_clean": _sql(
            ("raw_products", "clean_products"), "SELECT * FROM clean_products"
        ),
        "merge_summary": _merged("="),
        "merge_summary_null_safe": null_safe,
        "merge_inserts_columns": f"""SELECT year, product_category, product_sub_category,
  customer_name, total_profit,
  CASE WHEN merge_action <> 'inserted' THEN 'system_user' END AS created_by,
  CAST(NULL AS VARCHAR) AS updated_by
FROM ({null_safe}) m""",
        "merge_table": f"""SELECT year, product_category, product_sub_category,
  customer_name, total_profit
FROM ({null_safe}) m""",
        "append_batches": _sql(
            ("raw_customers", "clean_customers"),
            "SELECT *, 'system_user' AS created_by, CAST(NULL AS VARCHAR) AS updated_by"
            " FROM clean_customers WHERE postal_code IS NOT NULL UNION ALL"
            " SELECT *, 'system_user', NULL FROM clean_customers WHERE postal_code IS NULL",
        ),
        "catalog_tables": _counts(
            ("raw_orders", "raw_customers", "raw_products", "clean_customers", "clean_products"),
            "table_name",
            {
                "raw_customers": "raw_customers",
                "raw_products": "raw_products",
                "raw_orders": "raw_orders",
                "customers": "clean_customers",
                "products": "clean_products",
                "transactions": "",
                "sales_summary": "",
            },
        ),
        "row_counts": _counts(
            _CLEAN,
            "step",
            {
                "orders_read": "raw_orders",
                "orders_valid": "valid_orders",
                "customers_valid": "clean_customers",
                "products_valid": "clean_products",
                "transactions": "clean_sales",
            },
            True,
        ),
        "csv_scan": _sql(("raw_products",), products_text),
        "csv_mixed_headers": _sql(("raw_products",), products_text),
        "json_broken_records": _sql(("raw_orders",), """SELECT row_id, order_id, quantity,
  CAST(NULL AS VARCHAR) AS broken_record FROM raw_orders WHERE row_id % 97 <> 0
UNION ALL SELECT NULL, NULL, NULL, '{"Row ID": ' || CAST(row_id AS VARCHAR)
FROM raw_orders WHERE row_id % 97 = 0"""),
        "json_scan": _sql(("raw_orders",), "SELECT * FROM raw_orders"),
        "xlsx_scan": _sql(("raw_customers",), "SELECT * FROM raw_customers"),
        "xlsx_scan_inferred": _sql(("raw_customers",), "SELECT * FROM raw_customers"),
        "xlsx_types": """
            SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
                   CAST(o_orderdate AS DATE) AS o_orderdate, o_custkey % 2 = 0 AS even,
                   CASE WHEN o_orderkey % 1000 = 0 THEN 'none'
                        ELSE CAST(o_custkey AS VARCHAR) END AS mixed
            FROM orders
        """,
        "ingest_products": _sql(
            ("raw_products",),
            "SELECT *, DATE '2020-01-01' AS created_dt, 'system_user' AS created_by"
            f" FROM ({products_text}) t",
        ),
        "report_pack": _sql(
            (*_CLEAN, "clean_summary"),
            """SELECT 'profit_by_year' AS report, year, CAST(NULL AS VARCHAR) AS product_category,
  CAST(NULL AS VARCHAR) AS customer_name, CAST(SUM(total_profit) AS DECIMAL(30,2)) AS total
FROM clean_summary GROUP BY year
UNION ALL SELECT 'profit_by_year_category', year, product_category, NULL,
  CAST(SUM(total_profit) AS DECIMAL(30,2)) FROM clean_summary GROUP BY year, product_category
UNION ALL SELECT 'profit_by_customer', NULL, NULL, customer_name,
  CAST(SUM(total_profit) AS DECIMAL(30,2)) FROM clean_summary GROUP BY customer_name
UNION ALL SELECT 'profit_by_customer_year', year, NULL, customer_name,
  CAST(SUM(total_profit) AS DECIMAL(30,2)) FROM clean_summary GROUP BY customer_name, year""",
            True,
        ),
        "full_run": final_summary,
    }
