"""The same results as ``workload`` written as plain SQL, for checking it with another engine."""

from __future__ import annotations

# Fixed values below: the price classes' limits, the date patterns and the service types.
_SALES = """
sales AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS vin,
           CAST(o_custkey AS VARCHAR) AS customer_id,
           o_orderpriority AS model,
           CAST(o_orderdate AS DATE) AS invoice_date,
           CAST(CAST(round(o_totalprice * 1000) AS BIGINT) AS DECIMAL(38, 5)) AS price,
           CAST(o_orderdate AS TIMESTAMP) AS created_at
    FROM orders
),
classed AS (
    SELECT *, CASE WHEN price > 400000000 THEN 'HIGH'
                   WHEN price >= 250000001 THEN 'MEDIUM'
                   WHEN price > 250000000 THEN NULL
                   WHEN price >= 100000000 THEN 'LOW' END AS class
    FROM sales
)"""

_SERVICES = """
services AS (
    SELECT CAST(event_id AS VARCHAR) AS service_ticket,
           event_type AS vin,
           CAST(user_id AS VARCHAR) AS customer_id,
           event_type AS model,
           CAST(ts AS DATE) AS service_date,
           CASE event_id % 3 WHEN 0 THEN 'BP' WHEN 1 THEN 'PM' ELSE 'GR' END AS service_type,
           make_timestamp(CAST(round(epoch_us(ts) / 1000.0) AS BIGINT) * 1000) AS created_at
    FROM events
)"""

_CUSTOMERS = """
born AS (
    SELECT *, DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS day FROM customer
),
spelled AS (
    SELECT c_custkey, c_nationkey, c_name,
           CASE c_custkey % 5 WHEN 0 THEN strftime(day, '%Y-%m-%d')
                              WHEN 1 THEN strftime(day, '%Y/%m/%d')
                              WHEN 2 THEN strftime(day, '%d/%m/%Y')
                              WHEN 3 THEN '30/02/1990' END AS dob,
           make_timestamp(epoch_us(TIMESTAMP '2025-03-01') + 1000 * CAST(round(c_custkey * 1012.6) AS BIGINT))
               AS created_at
    FROM born
),
customers AS (
    SELECT c_custkey, c_nationkey, c_name, dob, created_at,
           CASE WHEN regexp_matches(dob, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')
                THEN CAST(try_strptime(dob, '%Y-%m-%d') AS DATE)
                WHEN regexp_matches(dob, '^[0-9]{4}/[0-9]{2}/[0-9]{2}$')
                THEN CAST(try_strptime(dob, '%Y/%m/%d') AS DATE)
                WHEN regexp_matches(dob, '^[0-9]{2}/[0-9]{2}/[0-9]{4}$')
                THEN CAST(try_strptime(dob, '%d/%m/%Y') AS DATE) END AS birth_date
    FROM spelled
)"""

_ADDRESSES = r"""
addresses AS (
    SELECT 'A' || c_custkey AS id, c_custkey, c_nationkey,
           '"' || n_name || '" \ RT 1/RW 2, ' || c_name AS address,
           CASE WHEN c_acctbal >= 0 THEN n_name END AS city,
           r_name AS province
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

_STORED_ADDRESSES = """
stored AS (
    SELECT 'S' || c_custkey AS id, CAST(c_custkey * 2 AS VARCHAR) AS customer_id, c_name AS address,
           'Bekasi' AS city, 'Jawa Barat' AS province, TIMESTAMP '2024-01-01 00:00:00' AS created_at,
           CASE c_mktsegment WHEN 'BUILDING' THEN TIMESTAMP '2025-09-01 08:00:00'
                             ELSE TIMESTAMP '2025-08-01 08:00:00' END AS load_timestamp
    FROM customer
)"""

_LOADED = "TIMESTAMP '2025-09-01 08:00:00' AS load_timestamp"

_SERVICE_MART = f"""
WITH {_SERVICES}, {_ADDRESSES}
SELECT CAST(year(s.service_date) AS INTEGER) AS periode, s.vin, c.c_name AS customer_name, a.address,
       CAST(count(*) AS INTEGER) AS count_service,
       CASE WHEN count(*) > 10 THEN 'HIGH' WHEN count(*) >= 5 THEN 'MED' ELSE 'LOW' END AS priority
FROM services s
JOIN customer c ON s.customer_id = CAST(c.c_custkey * 2 AS VARCHAR)
LEFT JOIN addresses a ON s.customer_id = CAST(a.c_custkey * 3 AS VARCHAR)
GROUP BY year(s.service_date), s.vin, s.customer_id, c.c_name, a.address"""


def oracle_sql() -> dict[str, str]:
    return {
        "mart_sales": f"""
            WITH {_SALES}
            SELECT strftime(invoice_date, '%Y-%m') AS periode, class, model, sum(price) AS total
            FROM classed GROUP BY 1, 2, 3""",
        "mart_sales_rejects": f"""
            WITH {_SALES}
            SELECT vin, customer_id, model, invoice_date, price, created_at FROM classed WHERE class IS NULL""",
        "mart_cust_service_prio": _SERVICE_MART,
        "mart_cust_service_prio_loaded": _SERVICE_MART,
        "txf_sales_loaded": f"""
            WITH {_SALES},
            twice AS (
                SELECT vin, customer_id, model, CAST(invoice_date + INTERVAL 25 YEAR AS DATE) AS invoice_date, price,
                       TIMESTAMP '2025-08-01 08:00:00' AS created_at, TIMESTAMP '2025-09-01 08:00:00' AS load_timestamp FROM sales
                UNION ALL
                SELECT vin, customer_id, model, CAST(invoice_date + INTERVAL 27 YEAR AS DATE), price,
                       TIMESTAMP '2025-09-02 06:30:00', TIMESTAMP '2025-09-02 08:00:00' FROM sales)
            SELECT *, CAST(load_timestamp AS DATE) AS load_date,
                   CASE WHEN year(invoice_date) <= 2022 THEN 'p2022' WHEN year(invoice_date) <= 2025 THEN 'p' || year(invoice_date)
                        ELSE 'pmax' END AS inv_bucket
            FROM twice""",
        "txf_sales_initial": f"WITH {_SALES} SELECT *, {_LOADED} FROM sales",
        "txf_sales_incremental": f"""
            WITH {_SALES} SELECT *, {_LOADED} FROM sales WHERE created_at >= TIMESTAMP '1998-02-06'
            AND created_at < TIMESTAMP '1998-02-07'""",
        "txf_sales_rerun": f"""
            WITH {_SALES}
            SELECT *, CASE WHEN CAST(created_at AS DATE) = DATE '1998-02-06' THEN TIMESTAMP '1998-02-06 09:30:00'
                           ELSE created_at + INTERVAL 8 HOUR END AS load_timestamp
            FROM sales""",
        "sales_inv_bucket": """
            SELECT CASE WHEN year(day) <= 2022 THEN 'p2022' WHEN year(day) <= 2025 THEN 'p' || year(day)
                        ELSE 'pmax' END AS inv_bucket,
                   count(*) AS sales, min(day) AS first_invoice, max(day) AS last_invoice
            FROM (SELECT CAST(o_orderdate + INTERVAL 25 YEAR AS DATE) AS day FROM orders)
            GROUP BY 1""",
        "txf_after_sales_rerun": f"""
            WITH {_SERVICES} SELECT *, {_LOADED} FROM services
            UNION ALL
            SELECT 'N' || service_ticket, vin, customer_id, model, service_date, service_type,
                   TIMESTAMP '2025-09-02 06:30:00', TIMESTAMP '2025-09-02 08:00:00' FROM services""",
        "txf_after_sales_initial": f"WITH {_SERVICES} SELECT *, {_LOADED} FROM services",
        "txf_after_sales_incremental": f"""
            WITH {_SERVICES} SELECT *, {_LOADED} FROM services WHERE service_date = DATE '2024-01-15'""",
        "txf_customers_dob": f"""
            WITH {_CUSTOMERS} SELECT CAST(c_custkey AS VARCHAR) AS id, dob, birth_date FROM customers""",
        "txf_customers_upsert": f"""
            WITH {_CUSTOMERS},
            fresh AS (SELECT CAST(c_custkey * 2 AS VARCHAR) AS id, c_name AS name, birth_date AS dob, created_at,
                             {_LOADED} FROM customers),
            kept AS (SELECT CAST(c_custkey AS VARCHAR) AS id, 'former ' || c_name AS name, DATE '1970-01-01' AS dob,
                            TIMESTAMP '2024-01-01' AS created_at, TIMESTAMP '2025-08-01 08:00:00' AS load_timestamp
                     FROM customer WHERE c_mktsegment <> 'BUILDING')
            SELECT * FROM fresh
            UNION ALL SELECT * FROM kept WHERE id NOT IN (SELECT id FROM fresh)""",
        "txf_address_upsert": f"""
            WITH {_ADDRESSES}, {_STORED_ADDRESSES},
            fresh AS (SELECT *, CAST(c_custkey * 3 AS VARCHAR) AS customer_id FROM addresses),
            kept AS (SELECT * FROM stored WHERE CAST(load_timestamp AS DATE) <> DATE '2025-09-01')
            SELECT coalesce(k.id, f.id) AS id, f.customer_id, f.address, f.city, f.province,
                   TIMESTAMP '2026-03-01 14:24:40.013' AS created_at, {_LOADED}
            FROM fresh f LEFT JOIN kept k ON k.customer_id = f.customer_id
            UNION ALL
            SELECT * FROM kept WHERE customer_id NOT IN (SELECT customer_id FROM fresh)""",
        "csv_ingest": f"""
            WITH {_ADDRESSES}, {_STORED_ADDRESSES},
            lines AS (SELECT *, CAST(c_custkey + c_nationkey AS VARCHAR) AS customer_id,
                             row_number() OVER (PARTITION BY c_custkey + c_nationkey ORDER BY c_custkey) AS nth,
                             row_number() OVER (PARTITION BY c_custkey + c_nationkey ORDER BY c_custkey DESC) AS nth_last
                      FROM addresses)
            SELECT coalesce(s.id, f.id) AS id, l.customer_id, l.address, l.city, l.province,
                   '2026-03-01 14:24:40.0125' AS created_at, {_LOADED}
            FROM lines l JOIN lines f ON f.customer_id = l.customer_id AND f.nth = 1
            LEFT JOIN stored s ON s.customer_id = l.customer_id
            WHERE l.nth_last = 1
            UNION ALL
            SELECT id, customer_id, address, city, province, CAST(created_at AS VARCHAR), load_timestamp
            FROM stored WHERE customer_id NOT IN (SELECT customer_id FROM lines)""",
        "dedupe_first_last": """
            WITH ranked AS (
                SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth,
                       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth_last
                FROM orders)
            SELECT CAST(l.o_custkey AS VARCHAR) AS customer_id, CAST(f.o_orderkey AS VARCHAR) AS id,
                   l.o_orderpriority AS model, nullif(l.o_orderstatus, 'P') AS status
            FROM ranked l JOIN ranked f ON f.o_custkey = l.o_custkey AND f.nth = 1
            WHERE l.nth_last = 1""",
        "ts_millis": f"WITH {_SERVICES} SELECT service_ticket, created_at FROM services",
        "pk_violations_sales": """
            WITH batch AS (SELECT CAST(o_custkey AS VARCHAR) AS vin, CAST(o_orderdate AS DATE) AS invoice_date
                           FROM orders),
            stored AS (SELECT CAST(l_partkey AS VARCHAR) AS vin, CAST(l_shipdate AS DATE) AS invoice_date FROM lineitem)
            SELECT vin, invoice_date, count(*) AS copies, 'repeated in batch' AS reason
            FROM batch GROUP BY vin, invoice_date HAVING count(*) > 1
            UNION ALL
            SELECT s.vin, s.invoice_date,
                   (SELECT count(*) FROM batch b WHERE b.vin = s.vin AND b.invoice_date = s.invoice_date),
                   'already stored'
            FROM stored s
            WHERE EXISTS (SELECT 1 FROM batch b WHERE b.vin = s.vin AND b.invoice_date = s.invoice_date)""",
        "pk_violations_after_sales": """
            WITH batch AS (SELECT o_orderkey * 3 AS ticket, CASE WHEN o_totalprice >= 100000 THEN 2 ELSE 1 END AS copies FROM orders),
            counted AS (SELECT CAST(ticket AS VARCHAR) AS service_ticket, sum(copies)::BIGINT AS copies FROM batch GROUP BY ticket)
            SELECT service_ticket, copies, 'repeated in batch' AS reason FROM counted WHERE copies > 1
            UNION ALL
            SELECT service_ticket, copies, 'already stored' FROM counted
            WHERE service_ticket IN (SELECT CAST(event_id AS VARCHAR) FROM events)""",
        "not_null_violations": f"""
            WITH {_SALES}
            SELECT 'vin is null' AS rule, count(*) AS violations FROM sales WHERE model = '2-HIGH'
            UNION ALL
            SELECT 'invoice_date is null', count(*) FROM sales WHERE price < 50000000""",
        "length_violations": f"""
            WITH {_SERVICES}
            SELECT 'service_ticket longer than 10' AS rule, count(*) AS violations FROM services
            WHERE length('T-' || service_ticket || '-' || vin) > 10
            UNION ALL SELECT 'vin longer than 50', count(*) FROM services WHERE length(vin) > 50
            UNION ALL SELECT 'customer_id longer than 255', count(*) FROM services WHERE length(customer_id) > 255
            UNION ALL SELECT 'model longer than 50', count(*) FROM services WHERE length(model) > 50
            UNION ALL SELECT 'service_type longer than 5', count(*) FROM services WHERE length(vin) > 5""",
        "load_report": f"""
            WITH {_CUSTOMERS}
            SELECT 'rows read' AS measure, count(*) AS amount FROM customers
            UNION ALL SELECT 'missing birth dates', count(*) FROM customers WHERE dob IS NULL
            UNION ALL SELECT 'unreadable birth dates', count(*) FROM customers
                      WHERE dob IS NOT NULL AND birth_date IS NULL
            UNION ALL SELECT 'rows loaded', count(DISTINCT c_custkey + c_nationkey) FROM customers""",
        "load_reports": f"""
            WITH {_CUSTOMERS}, {_ADDRESSES},
            amounts AS (SELECT
                (SELECT count(*) FROM addresses) AS lines,
                (SELECT count(DISTINCT c_custkey + c_nationkey) FROM addresses) AS placed,
                (SELECT count(*) FROM customers) AS staged,
                (SELECT count(DISTINCT c_custkey + c_nationkey) FROM customers) AS people,
                (SELECT count(*) FROM customers WHERE dob IS NOT NULL AND birth_date IS NULL) AS unreadable,
                (SELECT count(*) FROM orders) AS sold)
            SELECT unnest(['stg_customer_address', 'stg_customer_address', 'stg_customer_address', 'txf_customers', 'txf_customers',
                           'txf_customers', 'txf_customer_address', 'txf_customer_address', 'txf_sales', 'txf_sales']) AS table_name,
                   unnest(['rows read', 'rows written', 'malformed lines', 'rows read', 'rows written', 'unreadable birth dates',
                           'rows read', 'rows written', 'rows read', 'rows written']) AS measure,
                   unnest([lines, placed, 0, staged, people, unreadable, placed, placed, sold, sold]) AS amount
            FROM amounts""",
    }
