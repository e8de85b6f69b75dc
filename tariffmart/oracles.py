"""The registered queries as SQL for DuckDB, written from the row-by-row meaning (joins of all pairs included)."""

from __future__ import annotations

from tariffmart.plans.audit import THRESHOLDS
from tariffmart.sources import seed_values

K = "sku, region_code, channel_code"
AS_OF = "DATE '2001-08-01'"
EARLY = "DATE '2000-01-01'"
FIRST_AT = "TIMESTAMP '2001-08-01 00:00:00'"
SECOND_AT = "TIMESTAMP '2001-08-02 00:00:00'"
OPEN = "DATE '9999-12-31'"


def _same_key(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in K.split(", "))


def _copied(select: str, source: str, where: str = "TRUE") -> str:
    return (
        f"SELECT {select} FROM {source} WHERE {where} "
        f"UNION ALL SELECT {select} FROM {source} WHERE ({where}) AND l_orderkey % 53 = 0"
    )


def _facts(
    id_column: str, columns: str, order: str, source: str, required: list[str], at: str, facts: str | None
) -> str:
    """Distinct complete rows that the facts lack, numbered after their highest id."""
    complete = " AND ".join(f"{c} IS NOT NULL" for c in required)
    known = f" EXCEPT SELECT {columns} FROM {facts}" if facts else ""
    after = f"(SELECT max({id_column}) FROM {facts})" if facts else "0"
    return (
        f"SELECT {after} + row_number() OVER (ORDER BY {order}) AS {id_column}, *, {at} AS created_at"
        f" FROM (SELECT DISTINCT {columns} FROM {source} WHERE {complete}{known})"
    )


_SALE = f"sale_date, {K}, qty, net_sales"
_DISCOUNT = f"{K}, discount_type, discount_value, start_date, end_date"
_KEYS = K.split(", ")


def _sales_facts(source: str, at: str = FIRST_AT, facts: str | None = None) -> str:
    return _facts("sale_id", _SALE, _SALE, source, ["sale_date", *_KEYS], at, facts)


def _discount_facts(source: str, at: str = FIRST_AT, facts: str | None = None) -> str:
    order = f"{K}, start_date, end_date, discount_type NULLS FIRST, discount_value"
    return _facts("discount_event_id", _DISCOUNT, order, source, [*_KEYS, "start_date", "end_date"], at, facts)


PRICE_RULES = "sku IS NOT NULL AND trim(sku) <> '' AND price >= 0 AND effective_start IS NOT NULL"


def _price_match(facts: str) -> str:
    return (
        f" AND NOT EXISTS (FROM {facts} f WHERE {_same_key('f', 's')} AND f.effective_start = s.effective_start"
        f" AND coalesce(f.effective_end, {OPEN}) = coalesce(s.effective_end, {OPEN})"
        " AND f.price = s.price AND (s.currency IS NULL OR f.currency = s.currency))"
    )


def _price_facts(source: str, at: str = FIRST_AT, facts: str | None = None, members: str = "dim_product") -> str:
    after = f"(SELECT max(price_hist_id) FROM {facts})" if facts else "0"
    return (
        f"SELECT {after} + row_number() OVER (ORDER BY {K}, effective_start, effective_end NULLS FIRST, price, currency,"
        f" source_system NULLS FIRST) AS price_hist_id, *, {at} AS created_at FROM (SELECT DISTINCT {K}, price, currency,"
        f" effective_start, effective_end, source_system FROM {source} s WHERE {PRICE_RULES}"
        f" AND sku IN (SELECT sku FROM {members} WHERE sku IS NOT NULL){_price_match(facts) if facts else ''})"
    )


def _with_next(source: str) -> str:
    return (
        f"SELECT *, lead(effective_start) OVER (PARTITION BY {K} ORDER BY effective_start, created_at, price_hist_id)"
        f" AS nx FROM {source}"
    )


TOUCHED = "effective_end IS DISTINCT FROM nx - 1"
NEW_END = "CASE WHEN nx IS NOT NULL THEN greatest(nx - 1, effective_start) END"


def _repaired(source: str) -> str:
    return (
        f"SELECT price_hist_id, {K}, price, currency, effective_start,"
        f" CASE WHEN {TOUCHED} THEN {NEW_END} ELSE effective_end END AS effective_end, source_system, created_at"
        f" FROM ({_with_next(source)})"
    )


_KEYED = K
_REJECTED = (
    "SELECT count(*) AS n FROM {} WHERE coalesce(sku, '') NOT IN (SELECT sku FROM dim_product)"
    " OR price < 0 OR effective_start IS NULL"
)

PRICE_ORDER = "effective_start DESC, created_at DESC, price_hist_id DESC"
DISCOUNT_ORDER = "discount_value DESC, start_date, discount_event_id"
BEST_PRICE_OF_DAY = f"row_number() OVER (PARTITION BY as_of_date, {K} ORDER BY {PRICE_ORDER}) = 1"
BEST_DISCOUNT_OF_DAY = f"row_number() OVER (PARTITION BY as_of_date, {K} ORDER BY {DISCOUNT_ORDER}) = 1"

CTES: dict[str, str] = {
    "base": (
        "SELECT l.*, CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,"
        " upper(substr(r_name, 1, 2)) AS region_code, substr(c_mktsegment, 1, 4) AS channel_code,"
        " 'SKU-' || CAST(10000 + l_partkey // 10 AS VARCHAR) AS sku"
        " FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
        " JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
    ),
    "families": (
        "SELECT *, 'SKU-' || CAST(10000 + p_partkey // 10 AS VARCHAR) AS sku FROM part"
        " QUALIFY row_number() OVER (PARTITION BY p_partkey // 10 ORDER BY p_partkey) = 1"
    ),
    "dim_product": (
        "SELECT sku, p_name AS product_name, p_type AS category, p_brand AS brand, p_size <= 45 AS is_active"
        " FROM families WHERE p_partkey // 10 % 20 <> 19"
    ),
    "dim_region": "SELECT DISTINCT upper(substr(r_name, 1, 2)) AS region_code, r_name AS region_name FROM region",
    "dim_channel": "SELECT DISTINCT substr(c_mktsegment, 1, 4) AS channel_code, c_mktsegment AS channel_name FROM customer",
    "stg_sales": _copied(
        f"order_date AS sale_date, {_KEYED}, CAST(l_quantity AS INTEGER) AS qty,"
        " CAST(l_extendedprice AS DECIMAL(18,2)) AS net_sales,"
        " 'sales_' || strftime(order_date, '%Y_%m_%d') || '.csv' AS source_file",
        "base",
    ),
    "stg_price": _copied(
        "CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN '  ' ELSE sku END AS sku,"
        " region_code, channel_code,"
        " CAST(CASE WHEN l_orderkey % 97 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,4)) AS price,"
        " 'USD' AS currency, order_date AS effective_start,"
        " CASE WHEN l_linenumber % 2 = 1 THEN order_date + 30 END AS effective_end,"
        " CASE WHEN l_linenumber % 2 = 1 THEN 'PRICING_SYS' ELSE 'LATE_LOAD_SYS' END AS source_system",
        "base",
    ),
    "stg_disc": _copied(
        f"{_KEYED}, CASE WHEN l_returnflag = 'R' OR l_discount = 0 THEN 'FLAT' ELSE 'PERCENT' END AS discount_type,"
        " CAST(CASE WHEN l_returnflag = 'R' OR l_discount = 0 THEN l_quantity * 10 ELSE l_discount * 100 END AS DECIMAL(18,4)) AS discount_value,"
        " ship_date AS start_date, ship_date + CAST(7 + l_suppkey % 15 AS INTEGER) AS end_date",
        "base",
    ),
    "ok_sales": "SELECT * FROM stg_sales WHERE sku IN (SELECT sku FROM dim_product)",
    "ok_disc": "SELECT * FROM stg_disc WHERE sku IN (SELECT sku FROM dim_product)",
    "any_sku": "SELECT DISTINCT sku FROM stg_price",
    "fact_sales": _sales_facts("ok_sales"),
    "fact_disc": _discount_facts("ok_disc"),
    "price_new": _price_facts("stg_price"),
    "fact_price": _repaired("price_new"),
    "raw_sales": _sales_facts("stg_sales"),
    "raw_disc": _discount_facts("stg_disc"),
    "raw_price": _price_facts("stg_price", members="any_sku"),
    "early_ok_sales": f"SELECT * FROM ok_sales WHERE sale_date < {EARLY}",
    "early_ok_disc": f"SELECT * FROM ok_disc WHERE start_date < {EARLY}",
    "early_stg_price": f"SELECT * FROM stg_price WHERE effective_start < {EARLY}",
    "early_sales": _sales_facts("early_ok_sales"),
    "early_disc": _discount_facts("early_ok_disc"),
    "early_price_new": _price_facts("early_stg_price"),
    "early_price": _repaired("early_price_new"),
    "second_sales": _sales_facts("ok_sales", SECOND_AT, "early_sales"),
    "second_disc": _discount_facts("ok_disc", SECOND_AT, "early_disc"),
    "second_price": _price_facts("stg_price", SECOND_AT, "early_price"),
    "both_price": "SELECT * FROM early_price UNION ALL SELECT * FROM second_price",
    "final_price": _repaired("both_price"),
    "rejected": _REJECTED.format("stg_price"),
    "early_rejected": _REJECTED.format("early_stg_price"),
    "days": f"SELECT CAST({AS_OF} - CAST(n AS INTEGER) AS DATE) AS as_of_date FROM range(60) t(n)",
    "recent_keys": (
        f"SELECT {K} FROM fact_sales WHERE sale_date >= {AS_OF} - 60"
        f" UNION SELECT {K} FROM fact_price WHERE effective_start <= {AS_OF} AND (effective_end IS NULL OR effective_end >= {AS_OF} - 60)"
        f" UNION SELECT {K} FROM fact_disc WHERE start_date <= {AS_OF} AND end_date >= {AS_OF} - 60"
    ),
    "enriched": (
        "SELECT k.sku, product_name, category, brand, k.region_code, region_name, k.channel_code, channel_name"
        " FROM recent_keys k JOIN dim_product p ON k.sku = p.sku JOIN dim_region r ON k.region_code = r.region_code"
        " JOIN dim_channel c ON k.channel_code = c.channel_code WHERE is_active"
    ),
    "price_days": (
        f"SELECT as_of_date, {K}, price AS current_price, currency FROM days JOIN fact_price"
        f" ON as_of_date BETWEEN effective_start AND coalesce(effective_end, {OPEN}) QUALIFY {BEST_PRICE_OF_DAY}"
    ),
    "disc_days": (
        f"SELECT as_of_date, {K}, discount_type AS active_discount_type, discount_value AS active_discount_value"
        f" FROM days JOIN fact_disc ON as_of_date BETWEEN start_date AND end_date QUALIFY {BEST_DISCOUNT_OF_DAY}"
    ),
    "sales_days": (
        f"SELECT sale_date, {K}, sum(qty) AS daily_sales_qty, sum(net_sales) AS daily_net_sales FROM fact_sales"
        f" GROUP BY sale_date, {K}"
    ),
    "grid": (
        "SELECT d.as_of_date, e.*, coalesce(p.current_price, 0) AS current_price, coalesce(p.currency, 'USD') AS currency,"
        " x.active_discount_type, x.active_discount_value, coalesce(s.daily_sales_qty, 0) AS daily_sales_qty,"
        " coalesce(s.daily_net_sales, 0) AS daily_net_sales,"
        " CASE WHEN p.current_price IS NULL THEN 1 ELSE 0 END AS dq_missing_price_flag"
        " FROM days d CROSS JOIN enriched e"
        f" LEFT JOIN price_days p ON p.as_of_date = d.as_of_date AND {_same_key('p', 'e')}"
        f" LEFT JOIN disc_days x ON x.as_of_date = d.as_of_date AND {_same_key('x', 'e')}"
        f" LEFT JOIN sales_days s ON s.sale_date = d.as_of_date AND {_same_key('s', 'e')}"
    ),
}


def _with(select: str) -> str:
    """The query with the CTEs it needs, found by name, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split())
        for name in CTES:
            if name in words and name not in needed:
                needed.add(name)
                visit(CTES[name])

    visit(select)
    parts = [f"{name} AS ({body})" for name, body in CTES.items() if name in needed]
    return f"WITH {', '.join(parts)} {select}" if parts else select


GRID_OUT = (
    "as_of_date, sku, product_name, category, brand, region_code, region_name, channel_code, channel_name,"
    " CAST(current_price AS DOUBLE) AS current_price, currency, active_discount_type,"
    " CAST(active_discount_value AS DOUBLE) AS active_discount_value, CAST(daily_sales_qty AS BIGINT) AS daily_sales_qty,"
    " CAST(daily_net_sales AS DOUBLE) AS daily_net_sales, dq_missing_price_flag"
)
PRICE_COLS = f"{K}, CAST(price AS DOUBLE) AS price, currency, effective_start, effective_end, source_system"
DISC_COLS = f"{K}, discount_type, CAST(discount_value AS DOUBLE) AS discount_value, start_date, end_date"
SALE_COLS = f"sale_date, {K}, qty, CAST(net_sales AS DOUBLE) AS net_sales"
PRICE_KEY_OUT = f"price_hist_id, {K}, effective_start, effective_end"
CURRENT_OUT = f"{K}, CAST(price AS DOUBLE) AS current_price, currency, effective_start, effective_end"


def _draw(label: str, below: int, seeds: str) -> str:
    return f"(CAST(('0x' || substr(md5(concat_ws('|', '{label}', {seeds})), 1, 7)) AS BIGINT) % {below})"


def _pick(values: list[str], position: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {position} {cases} END"


_REGIONS = [c for c, _ in seed_values.REGIONS]
_CHANNELS = [c for c, _ in seed_values.CHANNELS]


def _random_price(label: str, seeds: str, scale: int) -> str:
    return f"CAST(CAST({_draw(label, 50000, seeds)} + 1000 AS DECIMAL(18,4)) * 0.01 AS DECIMAL(18,{scale}))"


def _sku_label(number: str) -> str:
    return f"'SKU-' || CAST(10000 + {number} AS VARCHAR)"


def _overlap_pairs(table: str, row_id: str, start: str, end: str, op: str) -> str:
    return (
        f"SELECT a.sku, a.region_code, a.channel_code, count(*) AS pairs FROM {table} a JOIN {table} b ON {_same_key('a', 'b')}"
        f" AND a.{row_id} < b.{row_id} WHERE a.{start} {op} coalesce(b.{end}, {OPEN}) AND b.{start} {op} coalesce(a.{end}, {OPEN})"
        " GROUP BY 1, 2, 3"
    )


def _total_pairs(table: str, row_id: str, start: str, end: str, op: str) -> str:
    return f"(SELECT CAST(coalesce(sum(pairs), 0) AS BIGINT) FROM ({_overlap_pairs(table, row_id, start, end, op)}))"


def _witness(table: str, row_id: str, start: str, end: str, op: str, strict: bool) -> str:
    """First by an earlier start with the latest end; else the day's smallest id among the overlapping."""
    return (
        f"SELECT sku, region_code, channel_code, first_id, second_id FROM (SELECT b.sku, b.region_code, b.channel_code,"
        f" a.{row_id} AS first_id, b.{row_id} AS second_id, row_number() OVER (PARTITION BY b.{row_id} ORDER BY"
        f" CASE WHEN a.{start} < b.{start} THEN 0 ELSE 1 END, CASE WHEN a.{start} < b.{start} THEN coalesce(a.{end}, {OPEN}) END DESC NULLS LAST,"
        f" CASE WHEN a.{start} < b.{start} THEN -a.{row_id} ELSE a.{row_id} END) AS rn"
        f" FROM {table} a JOIN {table} b ON {_same_key('a', 'b')} AND a.{row_id} <> b.{row_id}"
        f" AND a.{start} <= b.{start} AND a.{start} {op} coalesce(b.{end}, {OPEN}) AND b.{start} {op} coalesce(a.{end}, {OPEN})"
        f" WHERE a.{start} < b.{start} OR a.{row_id} = (SELECT min(c.{row_id}) FROM {table} c WHERE {_same_key('c', 'b')}"
        f" AND c.{start} = b.{start}{f' AND coalesce(c.{end}, {OPEN}) > c.{start}' if strict else ''})"
        ") WHERE rn = 1"
    )


def _orphans(table: str) -> str:
    return (
        f"({table}.sku NOT IN (SELECT sku FROM dim_product) OR {table}.region_code NOT IN (SELECT region_code FROM dim_region)"
        f" OR {table}.channel_code NOT IN (SELECT channel_code FROM dim_channel))"
    )


def _unpriced(sales: str, prices: str, as_of: str = AS_OF) -> str:
    return (
        f"SELECT {K} FROM {sales} WHERE sale_date >= {as_of} - 30 EXCEPT SELECT {K} FROM {prices} WHERE effective_end IS NULL"
    )


def _check_rows(as_of: str = AS_OF) -> str:
    """The five checks on the loaded facts."""
    counts = [
        (1, "Negative Prices", True, "(SELECT count(*) FROM fact_price WHERE price < 0)"),
        (2, "Overlapping Effective Ranges", True, _total_pairs("fact_price", "price_hist_id", "effective_start", "effective_end", "<")),
        (
            3,
            "Orphan Facts",
            True,
            f"(SELECT count(*) FROM fact_sales WHERE {_orphans('fact_sales')})"
            f" + (SELECT count(*) FROM fact_price WHERE {_orphans('fact_price')})",
        ),
        (4, "Overlapping Active Discounts", False, _total_pairs("fact_disc", "discount_event_id", "start_date", "end_date", "<=")),
        (5, "Missing Current Price Coverage", True, f"(SELECT count(*) FROM ({_unpriced('fact_sales', 'fact_price', as_of)}))"),
    ]
    return " UNION ALL ".join(
        f"SELECT CAST({n} AS INTEGER) AS check_no, '{name}' AS check_name, CASE WHEN {count} > 0 THEN '{'FAIL' if critical else 'WARNING'}'"
        f" ELSE 'PASS' END AS status, CAST({count} AS BIGINT) AS issue_count, {critical} AS critical"
        for n, name, critical, count in counts
    )


def _overall(checks: str) -> str:
    return f"(SELECT CASE WHEN count(*) FILTER (WHERE status = 'FAIL' AND critical) > 0 THEN 'FAIL' ELSE 'PASS' END FROM ({checks}))"


def _report_rows(as_of: str, stamp: str) -> str:
    checks = _check_rows(as_of)
    return f"SELECT '{stamp}' AS generated_at, {_overall(checks)} AS overall_status, check_name, status, issue_count FROM ({checks})"


_STAGED_OVERLAPS = (
    f"SELECT DISTINCT {K}, start_date, end_date FROM stg_disc a WHERE EXISTS (FROM stg_disc b WHERE {_same_key('a', 'b')}"
    " AND a.start_date <= b.end_date AND b.start_date <= a.end_date AND NOT (a.start_date = b.start_date"
    " AND a.end_date = b.end_date AND a.discount_type IS NOT DISTINCT FROM b.discount_type AND a.discount_value = b.discount_value))"
)

_MEASURES = {
    "stg_sales": "(SELECT count(*) FROM stg_sales)",
    "stg_price_history": "(SELECT count(*) FROM stg_price)",
    "stg_discount_events": "(SELECT count(*) FROM stg_disc)",
    "negative_price": "(SELECT count(*) FROM stg_price WHERE price < 0)",
    "missing_sku": "(SELECT count(*) FROM stg_price WHERE sku IS NULL OR trim(sku) = '')",
    "overlapping_discounts": f"(SELECT count(*) FROM ({_STAGED_OVERLAPS}))",
}


def _thresholds(names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS measure, CAST({_MEASURES[n]} AS BIGINT) AS actual, CAST({THRESHOLDS[n]} AS BIGINT) AS required,"
        f" CASE WHEN {_MEASURES[n]} >= {THRESHOLDS[n]} THEN 'PASS' ELSE 'FAIL' END AS status"
        for n in names
    )


def _counts(tables: dict[str, str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, CAST(count(*) AS BIGINT) AS row_count{extra} FROM {source}" for label, source in tables.items()
    )


_STAGED = {"stg_sales": "stg_sales", "stg_price_history": "stg_price", "stg_discount_events": "stg_disc"}
_LOADED = {"fact_sales": "fact_sales", "fact_price_history": "fact_price", "fact_discount_events": "fact_disc"}

_FAN_OUT = (
    "SELECT s.sku, CAST(sum(s.qty) AS BIGINT) AS total_qty, CAST(sum(s.net_sales) AS DOUBLE) AS total_sales,"
    " CAST(max(h.price) AS DOUBLE) AS current_price, CAST(max(e.discount_value) AS DOUBLE) AS active_discount_value"
    f" FROM fact_sales s JOIN dim_product p ON p.sku = s.sku JOIN fact_price h ON {_same_key('h', 's')}"
    f" AND {AS_OF} BETWEEN h.effective_start AND coalesce(h.effective_end, {OPEN})"
    f" JOIN fact_disc e ON {_same_key('e', 's')} AND {AS_OF} BETWEEN e.start_date AND e.end_date"
    f" WHERE s.sale_date BETWEEN {AS_OF} - 365 AND {AS_OF} AND s.region_code = 'AS' AND s.channel_code = 'BUIL' GROUP BY s.sku"
)


def _top_price(table: str, as_of: str = AS_OF) -> str:
    return (
        f"SELECT sku, CAST(price AS DOUBLE) AS current_price FROM {table} WHERE region_code = 'AS' AND channel_code = 'BUIL'"
        f" AND {as_of} BETWEEN effective_start AND coalesce(effective_end, {OPEN})"
        f" QUALIFY row_number() OVER (PARTITION BY sku ORDER BY {PRICE_ORDER}) = 1"
    )


def _top_discount(as_of: str = AS_OF) -> str:
    return (
        "SELECT sku, CAST(discount_value AS DOUBLE) AS active_discount_value FROM fact_disc WHERE region_code = 'AS'"
        f" AND channel_code = 'BUIL' AND {as_of} BETWEEN start_date AND end_date"
        f" QUALIFY row_number() OVER (PARTITION BY sku ORDER BY {DISCOUNT_ORDER}) = 1"
    )


def _sales_by_sku(days: int) -> str:
    return (
        "SELECT sku, CAST(sum(qty) AS BIGINT) AS total_qty, CAST(sum(net_sales) AS DOUBLE) AS total_sales FROM fact_sales"
        f" WHERE sale_date >= {AS_OF} - {days} AND sale_date <= {AS_OF} AND region_code = 'AS' AND channel_code = 'BUIL' GROUP BY sku"
    )


_TUNED = (
    f"SELECT s.sku, total_qty, total_sales, current_price, active_discount_value FROM ({_sales_by_sku(365)}) s"
    f" LEFT JOIN ({_top_price('fact_price')}) p ON s.sku = p.sku LEFT JOIN ({_top_discount()}) d ON s.sku = d.sku"
)

_SECOND_TOTAL = "(SELECT count(*) FROM second_sales) + (SELECT count(*) FROM second_disc) + (SELECT count(*) FROM second_price)"
_EARLY_TOTAL = "(SELECT count(*) FROM early_sales) + (SELECT count(*) FROM early_disc) + (SELECT count(*) FROM early_price)"
_FIRST_TOTAL = "(SELECT count(*) FROM fact_sales) + (SELECT count(*) FROM fact_disc) + (SELECT count(*) FROM fact_price)"

_RUN_ROWS = (
    f"SELECT CAST(1 AS BIGINT) AS run_id, 'SUCCESS' AS status, CAST({_EARLY_TOTAL} AS BIGINT) AS rows_loaded,"
    f" CAST((SELECT n FROM early_rejected) AS BIGINT) AS rows_rejected, '2001-08-01 00:00:00' AS run_at"
    " UNION ALL SELECT 2, 'FAILED', 0, 0, '2001-08-02 00:00:00'"
    f" UNION ALL SELECT 3, 'SUCCESS', {_SECOND_TOTAL}, (SELECT n FROM rejected), '2001-08-02 00:00:00'"
)

_DIFF_A = f"SELECT {K}, effective_start, effective_end FROM price_new"
_DIFF_B = f"SELECT {K}, effective_start, effective_end FROM fact_price"

_RAISED = "CASE WHEN source_system = 'LATE_LOAD_SYS' THEN price + 5.5 ELSE price END"
_OVERRIDES = (
    f"SELECT price_hist_id, {K}, price AS old_price, {_RAISED} AS new_price FROM fact_price"
    f" WHERE effective_end IS NULL AND price <> {_RAISED}"
)

_SKU_SEED = "sku, region_code, channel_code"
_START_SEED = "region_code, channel_code, CAST(effective_start AS VARCHAR)"
_TEXT_PRICES = (
    "concat_ws('|', '{label}', coalesce(sku, ''), coalesce(region_code, ''), coalesce(channel_code, ''), coalesce(CAST(price AS VARCHAR), ''),"
    " coalesce(currency, ''), coalesce(CAST(effective_start AS VARCHAR), ''), coalesce(CAST(effective_end AS VARCHAR), ''),"
    " coalesce(source_system, ''))"
)


def _random_staged(label: str, n: int) -> str:
    return f"SELECT * FROM stg_price ORDER BY md5({_TEXT_PRICES.replace('{label}', label)}) LIMIT {n}"


_BAD_SKUS = ", ".join(
    f"({'NULL' if sku is None else repr(sku)}, '{region}', '{channel}', {price})"
    for sku, region, channel, price in seed_values.BAD_SKU_PRICES
)

_BASELINE_GEN_DAYS = (
    f"SELECT sku, region_code, channel_code, {_draw('ranges', 4, _SKU_SEED)} + 1 AS ranges,"
    f" ({AS_OF} - 90) + CAST({_draw('first', 30, _SKU_SEED)} AS INTEGER) AS s1,"
    + ", ".join(f"CAST({_draw(f'length{i}', 30, _SKU_SEED)} + 1 AS INTEGER) AS l{i}" for i in range(3))
    + " FROM (SELECT DISTINCT 'SKU-' || CAST(10000 + p_partkey // 10 AS VARCHAR) AS sku FROM part) p CROSS JOIN (SELECT region_code FROM dim_region) r"
    " CROSS JOIN (SELECT channel_code FROM dim_channel) c"
)
_GEN_RANGES = (
    "SELECT g.sku, g.region_code, g.channel_code, i, g.ranges,"
    " s1 + CASE WHEN i > 1 THEN l0 + 1 ELSE 0 END + CASE WHEN i > 2 THEN l1 + 1 ELSE 0 END + CASE WHEN i > 3 THEN l2 + 1 ELSE 0 END AS s,"
    " CASE i WHEN 1 THEN l0 WHEN 2 THEN l1 WHEN 3 THEN l2 END AS len,"
    f" {_random_price('price', _SKU_SEED + ', CAST(i AS VARCHAR)', 4)} AS price"
    f" FROM ({_BASELINE_GEN_DAYS}) g JOIN range(1, 5) t(i) ON i <= g.ranges"
)

_IDS = "(SELECT CAST(o_orderkey + 1 AS BIGINT) AS id FROM orders)"

_LATE_KEYS = (
    "SELECT sku, region_code, channel_code FROM (SELECT sku FROM dim_product WHERE is_active) CROSS JOIN (SELECT region_code FROM dim_region)"
    " CROSS JOIN (SELECT channel_code FROM dim_channel)"
)

_CONTRACTS = [
    ("stg_sales", "stg_sales", ["sale_date", "sku", "region_code", "channel_code", "qty", "net_sales"], {}),
    ("stg_price_history", "stg_price", ["sku", "region_code", "channel_code", "price", "currency", "effective_start"], {"currency": 3, "source_system": 100}),
    ("stg_discount_events", "stg_disc", ["sku", "region_code", "channel_code", "discount_value", "start_date", "end_date"], {"discount_type": 100}),
]


def _contract_sql() -> str:
    parts = []
    for label, source, required, widths in _CONTRACTS:
        for c in required:
            parts.append(f"SELECT '{label}' AS table_name, '{c}' AS column_name, 'not_null' AS rule, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS row_count FROM {source}")
        for c, n in {"sku": 255, "region_code": 10, "channel_code": 10, **widths}.items():
            parts.append(f"SELECT '{label}', '{c}', 'max_length_{n}', CAST(count(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) FROM {source}")
    typed = {
        "stg_sales": ["sale_date", "qty", "net_sales"],
        "stg_price_history": ["price", "effective_start", "effective_end"],
        "stg_discount_events": ["discount_value", "start_date", "end_date"],
    }
    negative = "(SELECT count(*) FROM stg_price WHERE price < 0)"  # in brackets, which no number has
    for label, columns in typed.items():
        parts += [f"SELECT '{label}', '{c}', 'type', CAST({negative if c == 'price' else 0} AS BIGINT)" for c in columns]
    return " UNION ALL ".join(parts)


def _fk_sql() -> str:
    parts = []
    for label, source in {"fact_sales": "raw_sales", "fact_price_history": "raw_price", "fact_discount_events": "raw_disc"}.items():
        for column, dim in {"sku": "dim_product", "region_code": "dim_region", "channel_code": "dim_channel"}.items():
            parts.append(f"SELECT '{label}' AS table_name, '{column}' AS column_name, CAST(count(*) AS BIGINT) AS row_count FROM {source} f WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{column} = f.{column})")
    parts += [f"SELECT 'fact_margin_impact', '{c}', CAST(0 AS BIGINT)" for c in K.split(", ")]
    return " UNION ALL ".join(parts)


def _last_days(back: int) -> str:
    return f"(SELECT CAST({AS_OF} - CAST(n AS INTEGER) AS DATE) AS as_of_date FROM range({back + 1}) t(n))"


def _day_top_price(table: str, back: int) -> str:
    return (
        f"SELECT as_of_date, {K}, CAST(price AS DOUBLE) AS current_price, currency FROM {_last_days(back)} JOIN {table}"
        f" ON as_of_date BETWEEN effective_start AND coalesce(effective_end, {OPEN}) QUALIFY {BEST_PRICE_OF_DAY}"
    )


def _day_top_discount(back: int) -> str:
    return (
        f"SELECT as_of_date, {K}, discount_type AS active_discount_type, CAST(discount_value AS DOUBLE) AS active_discount_value"
        f" FROM {_last_days(back)} JOIN fact_disc ON as_of_date BETWEEN start_date AND end_date QUALIFY {BEST_DISCOUNT_OF_DAY}"
    )


_NO_DISC_TYPE = "CASE WHEN sku <> 'SKU-10010' THEN discount_type END"

_QUERIES: dict[str, str] = {
    "scan_tables": _counts({**{n: n for n in ["dim_product", "dim_region", "dim_channel"]}, **_STAGED, **_LOADED})
    + f" UNION ALL SELECT * FROM (VALUES ('dim_pricing_rule', CAST({len(seed_values.PRICING_RULES)} AS BIGINT)), ('etl_run_history', 1),"
    " ('fact_margin_impact', 0), ('price_override_audit', 0)) t(table_name, row_count)",
    "stage_with_lineage": "SELECT 'sales_' || strftime(sale_date, '%Y_%m') || '.csv' AS source_file, '2001-08-01 00:00:00' AS loaded_at,"
    " CAST(count(*) AS BIGINT) AS row_count, CAST(sum(net_sales) AS DOUBLE) AS net_sales FROM stg_sales GROUP BY 1",
    "contract_check": _contract_sql(),
    "dq_report_read": _report_rows(AS_OF, "2001-08-01T00:00:00"),
    "inline_rows": "SELECT s.discount_type, unit, CAST(count(*) AS BIGINT) AS row_count FROM stg_disc s JOIN (VALUES ('PERCENT', 'percent of price'),"
    " ('FLAT', 'amount per unit')) u(discount_type, unit) ON s.discount_type = u.discount_type GROUP BY 1, 2",
    "number_series": f"SELECT CAST(n AS INTEGER) AS n, CAST(count(sale_date) AS BIGINT) AS sales FROM range(60) t(n) LEFT JOIN fact_sales"
    f" ON sale_date = {AS_OF} - CAST(n AS INTEGER) GROUP BY n",
    "date_series": "SELECT as_of_date, CAST(coalesce(sum(qty), 0) AS BIGINT) AS qty FROM days LEFT JOIN fact_sales ON sale_date = as_of_date GROUP BY as_of_date",
    "gen_sales": f"SELECT sale_date, {K}, qty, CAST(CAST(qty * unit_price AS DECIMAL(18,2)) AS DOUBLE) AS net_sales,"
    f" 'sales_' || strftime(sale_date, '%Y_%m_%d') || '.csv' AS source_file FROM (SELECT ({AS_OF} - 60) + CAST({_draw('date', 61, 'CAST(id AS VARCHAR)')} AS INTEGER) AS sale_date,"
    f" {_sku_label(_draw('sku', 55, 'CAST(id AS VARCHAR)') + ' + 1')} AS sku, {_pick(_REGIONS, _draw('region', 6, 'CAST(id AS VARCHAR)'))} AS region_code,"
    f" {_pick(_CHANNELS, _draw('channel', 4, 'CAST(id AS VARCHAR)'))} AS channel_code, CAST({_draw('qty', 100, 'CAST(id AS VARCHAR)')} + 1 AS INTEGER) AS qty,"
    f" {_random_price('price', 'CAST(id AS VARCHAR)', 2)} AS unit_price FROM {_IDS})",
    "gen_price_history": "SELECT sku, CAST(count(*) AS BIGINT) AS row_count, CAST(count(*) FILTER (WHERE i = ranges) AS BIGINT) AS open_rows,"
    " CAST(sum(price) AS DOUBLE) AS total_price, min(s) AS first_start, max(s) AS last_start,"
    f" CAST(sum(CASE WHEN i < ranges THEN len END) AS BIGINT) AS closed_days FROM ({_GEN_RANGES}) GROUP BY sku",
    "gen_discounts": f"SELECT {K}, discount_type, CAST(CASE WHEN discount_type = 'PERCENT' THEN {_draw('percent', 50, 'CAST(id AS VARCHAR)')} + 5"
    f" ELSE {_draw('flat', 1000, 'CAST(id AS VARCHAR)')} + 10 END AS DOUBLE) AS discount_value, start_date,"
    f" start_date + CAST({_draw('length', 15, 'CAST(id AS VARCHAR)')} + 7 AS INTEGER) AS end_date FROM (SELECT id, {_sku_label('(id - 1) % 55 + 1')} AS sku,"
    f" {_pick(_REGIONS, _draw('region', 6, 'CAST(id AS VARCHAR)'))} AS region_code, {_pick(_CHANNELS, _draw('channel', 4, 'CAST(id AS VARCHAR)'))} AS channel_code,"
    f" {_pick(['PERCENT', 'FLAT'], _draw('type', 2, 'CAST(id AS VARCHAR)'))} AS discount_type,"
    f" ({AS_OF} - 30) + CAST({_draw('start', 30, 'CAST(id AS VARCHAR)')} AS INTEGER) AS start_date FROM {_IDS})",
    "inject_bad_rows": f"SELECT 'price' AS kind, {K}, CAST(-abs(price) AS DOUBLE) AS amount, source_system AS detail, effective_start AS first_day,"
    f" effective_end AS last_day FROM ({_random_staged('negate', 10)})"
    f" UNION ALL SELECT 'price', sku, region_code, channel_code, CAST(price AS DOUBLE), 'PRICING_SYS', {AS_OF} - 90, NULL FROM (VALUES {_BAD_SKUS}) t(sku, region_code, channel_code, price)"
    f" UNION ALL SELECT 'price', {_sku_label(_draw('late_sku', 55, _START_SEED) + ' + 1')}, region_code, channel_code, CAST({_random_price('late_price', _START_SEED, 4)} AS DOUBLE),"
    f" 'LATE_LOAD_SYS', {AS_OF} - 45, NULL FROM ({_random_staged('late', 5)})"
    f" UNION ALL SELECT 'discount', {', '.join(map(repr, seed_values.OVERLAP_KEY))}, CAST(value AS DOUBLE), kind, {AS_OF} - 20 + CAST(a AS INTEGER), {AS_OF} - 20 + CAST(b AS INTEGER)"
    f" FROM (VALUES {', '.join(map(str, seed_values.OVERLAPPING_DISCOUNTS))}) t(kind, value, a, b)",
    "inject_late_rows": f"SELECT kind, {K}, CASE kind WHEN 'price' THEN {AS_OF} - 35 ELSE {AS_OF} - 32 END AS on_date,"
    " CAST(CASE kind WHEN 'price' THEN 99.99 ELSE 999.90 END AS DOUBLE) AS amount FROM"
    f" (SELECT * FROM ({_LATE_KEYS}) ORDER BY md5(concat_ws('|', 'late_key', {K})) LIMIT 5) CROSS JOIN (VALUES ('price'), ('sale')) t(kind)",
    "staging_reload": "SELECT discount_type, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(discount_value) AS DOUBLE) AS total_value FROM stg_disc GROUP BY discount_type",
    "append_new": "SELECT '2001-08-01 00:00:00' AS created_at, CAST(count(*) AS BIGINT) AS row_count, CAST(max(sale_id) AS BIGINT) AS last_id FROM early_sales"
    " UNION ALL SELECT '2001-08-02 00:00:00', CAST(count(*) AS BIGINT), CAST(max(sale_id) AS BIGINT) FROM second_sales",
    "upsert_dim": "SELECT coalesce(t.sku, s.sku) AS sku, CASE WHEN s.sku IS NULL THEN t.product_name ELSE s.product_name END AS product_name,"
    " CASE WHEN s.sku IS NULL THEN t.category ELSE s.category END AS category, CASE WHEN s.sku IS NULL THEN t.brand ELSE s.brand END AS brand,"
    " CASE WHEN s.sku IS NULL THEN t.is_active ELSE s.is_active END AS is_active, t.sku IS NOT NULL AS existed FROM dim_product t FULL JOIN"
    " (SELECT sku, upper(p_name) AS product_name, p_type AS category,"
    " CASE WHEN p_size <= 25 THEN p_brand END AS brand, p_size <= 40 AS is_active FROM families) s ON t.sku = s.sku",
    "update_from_join": f"SELECT {PRICE_KEY_OUT} FROM fact_price",
    "surrogate_key": f"SELECT discount_event_id, {DISC_COLS} FROM fact_disc",
    "run_log": f"SELECT run_id, status, rows_loaded, rows_rejected, TRUE AS finished, status = 'FAILED' AS has_reason FROM ({_RUN_ROWS})",
    "dq_report_write": " UNION ALL ".join(
        f"SELECT generated_at, overall_status, check_name, issue_count FROM ({_report_rows(as_of, stamp)})"
        for as_of, stamp in [("DATE '2001-05-03'", "2001-05-03T00:00:00"), (AS_OF, "2001-08-01T00:00:00")]
    ),
    "atomic_publish": _counts(
        {"fact_sales": "early_sales", "fact_price_history": "early_price", "fact_discount_events": "early_disc"},
        ", 'after failed run' AS seen",
    )
    + " UNION ALL "
    + _counts(
        {
            "fact_sales": "(SELECT 1 FROM early_sales UNION ALL SELECT 1 FROM second_sales)",
            "fact_price_history": "final_price",
            "fact_discount_events": "(SELECT 1 FROM early_disc UNION ALL SELECT 1 FROM second_disc)",
        },
        ", 'after last run' AS seen",
    ),
    "scratch_tables": f"SELECT *, 'naive' AS form FROM ({_FAN_OUT}) UNION ALL SELECT *, 'tuned' FROM ({_TUNED})",
    "project_alias": f"SELECT {K}, CAST(price AS DOUBLE) AS current_price, currency, effective_start FROM fact_price",
    "required_not_null": "SELECT region_code, source_system, CAST(count(*) AS BIGINT) AS row_count FROM stg_price WHERE sku IS NOT NULL"
    " AND region_code IS NOT NULL AND channel_code IS NOT NULL AND effective_start IS NOT NULL GROUP BY 1, 2",
    "price_row_valid": f"SELECT {PRICE_COLS} FROM stg_price WHERE {PRICE_RULES} AND EXISTS (SELECT 1 FROM dim_product d WHERE d.sku = stg_price.sku)",
    "price_row_rejected": "SELECT CAST(n AS BIGINT) AS rows_rejected FROM rejected",
    "reject_reasons": f"SELECT 'negative_price' AS check_type, CAST({_MEASURES['negative_price']} AS BIGINT) AS row_count"
    f" UNION ALL SELECT 'missing_sku', CAST({_MEASURES['missing_sku']} AS BIGINT)",
    "active_on_date": f"SELECT {DISC_COLS} FROM fact_disc WHERE start_date <= {AS_OF} AND end_date >= {AS_OF}",
    "overlaps_range": f"SELECT {PRICE_KEY_OUT} FROM fact_price WHERE effective_start <= DATE '2001-03-31' AND (effective_end IS NULL OR effective_end >= DATE '2001-01-01')",
    "optional_filter": " UNION ALL ".join(
        f"SELECT '{label}' AS given, CAST(count(*) AS BIGINT) AS row_count FROM fact_price WHERE effective_end IS NULL"
        f" AND (CAST({region} AS VARCHAR) IS NULL OR region_code = {region}) AND (CAST({channel} AS VARCHAR) IS NULL OR channel_code = {channel})"
        for label, region, channel in [("none", "NULL", "NULL"), ("region", "'AS'", "NULL"), ("channel", "NULL", "'BUIL'"), ("both", "'AS'", "'BUIL'")]
    ),
    "current_rows": f"SELECT price_hist_id, {K}, CAST(price AS DOUBLE) AS price, effective_start FROM fact_price WHERE effective_end IS NULL",
    "recent_window": f"SELECT sale_id, {SALE_COLS} FROM fact_sales WHERE sale_date >= {AS_OF} - 30",
    "string_date_between": "SELECT CAST(sale_date AS VARCHAR) AS sale_day, CAST(count(*) AS BIGINT) AS row_count FROM fact_sales"
    f" WHERE CAST(sale_date AS VARCHAR) BETWEEN CAST({AS_OF} - 30 AS VARCHAR) AND CAST({AS_OF} AS VARCHAR) GROUP BY 1",
    "null_sentinel_equal": "SELECT o.price_hist_id, o.source_system, n.effective_end AS new_end FROM price_new o JOIN fact_price n"
    f" ON o.price_hist_id = n.price_hist_id WHERE coalesce(o.effective_end, {OPEN}) = coalesce(n.effective_end, {OPEN})",
    "null_wildcard_equal": f"SELECT DISTINCT {K}, CAST(price AS DOUBLE) AS price, currency, effective_start, effective_end, source_system FROM (SELECT * REPLACE (CASE WHEN source_system = 'PRICING_SYS' THEN currency END AS currency) FROM price_new) s"
    " WHERE TRUE" + _price_match("(SELECT * REPLACE (CASE WHEN region_code = 'AS' THEN 'EUR' ELSE 'USD' END AS currency) FROM price_new)"),
    "attr_differs": f"SELECT DISTINCT {', '.join('a.' + c for c in K.split(', '))}, a.start_date, a.end_date FROM stg_disc a JOIN stg_disc b ON {_same_key('a', 'b')}"
    " AND a.start_date = b.start_date AND a.end_date = b.end_date"
    " AND (coalesce(a.discount_type, '') <> coalesce(b.discount_type, '') OR a.discount_value <> b.discount_value)",
    "value_changed": f"SELECT price_hist_id, CAST(old_price AS DOUBLE) AS old_price, CAST(new_price AS DOUBLE) AS new_price FROM ({_OVERRIDES})",
    "active_products": "SELECT sku, product_name, category, brand FROM dim_product WHERE is_active",
    "dim_enrich": "SELECT * FROM enriched",
    "bi_left_joins": "SELECT as_of_date, region_code, CAST(count(*) AS BIGINT) AS grid_rows, CAST(sum(dq_missing_price_flag) AS BIGINT) AS without_price,"
    " CAST(count(active_discount_type) AS BIGINT) AS with_discount, CAST(sum(daily_sales_qty) AS BIGINT) AS qty, CAST(sum(daily_net_sales) AS DOUBLE) AS net_sales"
    " FROM grid GROUP BY 1, 2",
    "date_key_grid": "SELECT sku, as_of_date, CAST(count(*) AS BIGINT) AS keys FROM days CROSS JOIN recent_keys GROUP BY 1, 2",
    "price_as_of_daily": f"SELECT as_of_date, {K}, CAST(current_price AS DOUBLE) AS current_price, currency FROM price_days",
    "discount_as_of_daily": f"SELECT as_of_date, {K}, active_discount_type, CAST(active_discount_value AS DOUBLE) AS active_discount_value FROM disc_days",
    "dedup_anti_sales": f"SELECT {SALE_COLS} FROM second_sales",
    "dedup_anti_discounts": f"SELECT DISTINCT {DISC_COLS} FROM (SELECT * REPLACE ({_NO_DISC_TYPE} AS discount_type) FROM ok_disc) s WHERE NOT EXISTS (SELECT 1 FROM"
    f" (SELECT * REPLACE ({_NO_DISC_TYPE} AS discount_type) FROM early_disc) f WHERE f.start_date = s.start_date AND f.end_date = s.end_date"
    f" AND {_same_key('f', 's')} AND f.discount_value = s.discount_value AND f.discount_type = s.discount_type)",
    "dedup_anti_prices": f"SELECT {PRICE_COLS} FROM second_price",
    "sku_exists": "SELECT sku, CAST(count(*) AS BIGINT) AS row_count, sku IN (SELECT sku FROM dim_product) AS known FROM stg_sales GROUP BY sku",
    "orphan_facts": "SELECT CAST(3 AS INTEGER) AS check_no, 'Orphan Facts' AS check_name, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status,"
    f" CAST(n AS BIGINT) AS issue_count, TRUE AS critical FROM (SELECT (SELECT count(*) FROM raw_sales WHERE {_orphans('raw_sales')})"
    f" + (SELECT count(*) FROM raw_price WHERE {_orphans('raw_price')}) AS n)",
    "orphan_rows": f"SELECT 'fact_sales' AS table_name, sale_id AS row_id, {K} FROM raw_sales WHERE {_orphans('raw_sales')}"
    f" UNION ALL SELECT 'fact_price_history', price_hist_id, {K} FROM raw_price WHERE {_orphans('raw_price')}",
    "fk_violations": _fk_sql(),
    "price_overlap_pairs": _overlap_pairs("price_new", "price_hist_id", "effective_start", "effective_end", "<"),
    "discount_overlap_pairs": _overlap_pairs("fact_disc", "discount_event_id", "start_date", "end_date", "<="),
    "staging_discount_overlaps": _STAGED_OVERLAPS,
    "missing_price_coverage": _unpriced("stg_sales", "fact_price"),
    "price_override_audit": f"SELECT price_hist_id, {K}, CAST(old_price AS DOUBLE) AS old_price, CAST(new_price AS DOUBLE) AS new_price,"
    f" 'pricing desk' AS changed_by, '2001-08-02 00:00:00' AS changed_at FROM ({_OVERRIDES})",
    "sales_price_discount_naive": _FAN_OUT,
    "sales_price_discount": _TUNED,
    "key_universe": _LATE_KEYS,
    "repair_self_join": "SELECT price_hist_id, effective_end FROM fact_price",
    "sales_daily": f"SELECT sale_date, {K}, CAST(daily_sales_qty AS BIGINT) AS daily_sales_qty, CAST(daily_net_sales AS DOUBLE) AS daily_net_sales FROM sales_days",
    "sales_30d_by_sku": _sales_by_sku(30),
    "max_price_discount": f"SELECT sku, current_price, active_discount_value FROM ({_FAN_OUT})",
    "global_count": "SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(count(*) FILTER (WHERE price < 0) AS BIGINT) AS negative_rows FROM stg_price",
    "distinct_key_count": "SELECT 'sales' AS table_name, CAST(count(DISTINCT concat(sku, '|', region_code, '|', channel_code)) AS BIGINT) AS key_count FROM raw_sales"
    " UNION ALL SELECT 'prices', CAST(count(DISTINCT concat(sku, '|', region_code, '|', channel_code)) AS BIGINT) FROM stg_price",
    "row_distinct": f"SELECT DISTINCT {PRICE_COLS} FROM stg_price",
    "table_row_counts": _counts({**_STAGED, **_LOADED}),
    "volume_thresholds": _thresholds(["stg_sales", "stg_price_history", "stg_discount_events"]),
    "pk_duplicates": "SELECT 'lineitem' AS table_name, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS key_value,"
    " CAST(count(*) AS BIGINT) AS row_count FROM lineitem GROUP BY 2 HAVING count(*) > 1"
    " UNION ALL SELECT 'fact_sales', CAST(sale_id AS VARCHAR), CAST(count(*) AS BIGINT) FROM fact_sales GROUP BY 2 HAVING count(*) > 1"
    " UNION ALL SELECT 'fact_price_history', CAST(price_hist_id AS VARCHAR), CAST(count(*) AS BIGINT) FROM fact_price GROUP BY 2 HAVING count(*) > 1",
    "run_totals": f"SELECT CAST({_FIRST_TOTAL} AS BIGINT) AS rows_loaded, CAST((SELECT n FROM rejected) AS BIGINT) AS rows_rejected",
    "top_price_per_day": _day_top_price("price_new", 30),
    "top_discount_per_day": _day_top_discount(365),
    "top_price_per_sku": _top_price("price_new"),
    "top_discount_per_sku": _top_discount("DATE '2001-03-01'"),
    "next_effective_start": f"SELECT price_hist_id, {K}, effective_start, nx AS next_effective_start FROM ({_with_next('price_new')})",
    "repair_effective_ranges": f"SELECT {PRICE_KEY_OUT}, CAST(price AS DOUBLE) AS price FROM fact_price",
    "ranges_changed": f"SELECT price_hist_id, {K}, effective_start, effective_end AS old_end, {NEW_END} AS new_end FROM ({_with_next('price_new')}) WHERE {TOUCHED}",
    "current_price": f"SELECT {CURRENT_OUT} FROM fact_price WHERE sku = 'SKU-10007' AND region_code = 'AS' AND channel_code = 'BUIL' AND effective_end IS NULL"
    " ORDER BY fact_price.effective_start DESC LIMIT 1",
    "current_price_all": f"SELECT {CURRENT_OUT} FROM (FROM fact_price WHERE effective_end IS NULL QUALIFY row_number() OVER"
    f" (PARTITION BY {K} ORDER BY {PRICE_ORDER}) = 1)",
    "price_history": f"SELECT {K}, CAST(price AS DOUBLE) AS price, currency, effective_start, effective_end FROM fact_price WHERE sku = 'SKU-10007'"
    " AND effective_start <= DATE '2001-06-30' AND (effective_end IS NULL OR effective_end >= DATE '2000-01-01') AND region_code = 'AS'",
    "bi_snapshot": f"SELECT {GRID_OUT} FROM (SELECT * FROM grid WHERE as_of_date = DATE '2001-07-20' AND region_code = 'AS' AND channel_code = 'BUIL'"
    " ORDER BY daily_net_sales DESC, sku LIMIT 50)",
    "etl_runs": f"SELECT run_id, 'pricing_refresh' AS pipeline_name, run_at AS started_at, run_at AS finished_at, status, rows_loaded, rows_rejected FROM ({_RUN_ROWS})",
    "latest_run": f"SELECT run_id, run_at AS started_at, run_at AS finished_at, status, rows_loaded, rows_rejected, CAST(NULL AS VARCHAR) AS failure_reason FROM ({_RUN_ROWS}) WHERE run_id = 3",
    "sample_rows": f"SELECT 'price overlap' AS check_name, * FROM (SELECT * FROM ({_witness('price_new', 'price_hist_id', 'effective_start', 'effective_end', '<', True)}) ORDER BY second_id, first_id LIMIT 5)"
    f" UNION ALL SELECT 'discount overlap', * FROM (SELECT * FROM ({_witness('fact_disc', 'discount_event_id', 'start_date', 'end_date', '<=', False)}) ORDER BY second_id, first_id LIMIT 5)"
    f" UNION ALL SELECT 'no price', *, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM (SELECT * FROM ({_unpriced('stg_sales', 'fact_price')}) ORDER BY {K} LIMIT 5)",
    "random_sample": f"SELECT price_hist_id, {K}, CAST(price AS DOUBLE) AS price FROM fact_price ORDER BY md5('sample|' || CAST(price_hist_id AS VARCHAR)) LIMIT 20",
    "override_log_tail": f"SELECT audit_id, {K}, CAST(old_price AS DOUBLE) AS old_price, CAST(new_price AS DOUBLE) AS new_price, 'pricing desk' AS changed_by,"
    f" '2001-08-02 00:00:00' AS changed_at FROM (SELECT row_number() OVER (ORDER BY price_hist_id) AS audit_id, * FROM ({_OVERRIDES})) ORDER BY audit_id DESC LIMIT 5",
    "recent_activity_keys": "SELECT * FROM recent_keys",
    "union_all": " UNION ALL ".join(f"SELECT '{n}' AS table_name, region_code, CAST(count(*) AS BIGINT) AS row_count FROM {t} GROUP BY region_code" for n, t in _STAGED.items()),
    "result_diff": f"SELECT 'left' AS only_in, * FROM (({_DIFF_A}) EXCEPT ({_DIFF_B})) UNION ALL SELECT 'right', * FROM (({_DIFF_B}) EXCEPT ({_DIFF_A}))",
    "scalar_functions": "SELECT concat(sku, '|', region_code, '|', channel_code) AS key_text, effective_start + 7 AS week_later, effective_start - 30 AS month_before,"
    " CAST(effective_start AS VARCHAR) AS start_text, CAST(CAST(price * 0.01 AS DECIMAL(18,4)) AS DOUBLE) AS hundredth,"
    " CAST(CAST(price * 1.10 AS DECIMAL(18,2)) AS DOUBLE) AS raised, coalesce(effective_end, DATE '9999-12-31') AS end_or_open,"
    " CASE WHEN price < 0 THEN 'negative' WHEN price < 20000 THEN 'low' ELSE 'high' END AS band, trim(coalesce(sku, '')) = '' AS blank_sku,"
    " region_code || '-' || channel_code AS place, 'SKU-' || lpad(CAST(10000 + coalesce(try_cast(substr(sku, 5) AS INTEGER) - 10000, 0) AS VARCHAR), 5, '0') AS label,"
    " strftime(effective_start, '%Y_%m_%d') AS file_day, CAST(abs(price) AS DOUBLE) AS magnitude, CAST(-price AS DOUBLE) AS negated,"
    " try_cast(substr(sku, 5) AS INTEGER) % 7 AS remainder, try_cast(substr(sku, 5) AS INTEGER) AS sku_number,"
    " effective_start BETWEEN DATE '2000-01-01' AND DATE '2000-12-31' AS in_2000, coalesce(sku, '') <> 'SKU-10007' AS other_sku, effective_end IS NULL AS is_open"
    f" FROM (SELECT DISTINCT {K}, price, currency, effective_start, effective_end, source_system FROM stg_price)",
    "refresh_sales": f"SELECT sale_id, {SALE_COLS}, '2001-08-02 00:00:00' AS created_at FROM second_sales",
    "refresh_discounts": f"SELECT discount_event_id, {DISC_COLS}, '2001-08-02 00:00:00' AS created_at FROM second_disc",
    "refresh_prices": f"SELECT price_hist_id, {PRICE_COLS}, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM final_price",
    "refresh_mart": f"SELECT CAST(1 AS BIGINT) AS run_id, 'SUCCESS' AS status, CAST({_FIRST_TOTAL} AS BIGINT) AS rows_loaded, CAST((SELECT n FROM rejected) AS BIGINT) AS rows_rejected",
    "pricing_bi_dataset": f"SELECT {GRID_OUT} FROM grid",
    "dq_suite": _check_rows(),
    "negative_prices": f"SELECT CAST(1 AS INTEGER) AS check_no, 'Negative Prices' AS check_name, CASE WHEN {_MEASURES['negative_price']} > 0 THEN 'FAIL' ELSE 'PASS' END AS status,"
    f" CAST({_MEASURES['negative_price']} AS BIGINT) AS issue_count, TRUE AS critical",
    "staging_profile": _thresholds(list(THRESHOLDS)),
    "fact_sanity": " UNION ALL ".join(
        f"SELECT '{n}' AS measure, CAST(count(*) AS BIGINT) AS actual, 'INFO' AS status FROM {t}"
        for n, t in {"fact_sales": "fact_sales", "fact_price_history": "price_new", "fact_discount_events": "fact_disc"}.items()
    )
    + " UNION ALL SELECT 'negative_price', n, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT count(*) AS n FROM price_new WHERE price < 0)"
    f" UNION ALL SELECT 'price_overlaps', n, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT {_total_pairs('price_new', 'price_hist_id', 'effective_start', 'effective_end', '<')} AS n)",
    "verify_rewrite": f"SELECT left_rows, right_rows, only_left, only_right, CASE WHEN only_left = 0 AND only_right = 0 AND left_rows = right_rows THEN 'PASS' ELSE 'FAIL' END AS result FROM"
    f" (SELECT (SELECT CAST(count(*) AS BIGINT) FROM ({_FAN_OUT})) AS left_rows, (SELECT CAST(count(*) AS BIGINT) FROM ({_TUNED})) AS right_rows,"
    f" (SELECT CAST(count(*) AS BIGINT) FROM (({_FAN_OUT}) EXCEPT ({_TUNED}))) AS only_left, (SELECT CAST(count(*) AS BIGINT) FROM (({_TUNED}) EXCEPT ({_FAN_OUT}))) AS only_right)",
    "mart_audit": f"SELECT 'Staging data checks' AS section, (SELECT min(status) FROM ({_thresholds(list(THRESHOLDS))})) AS status UNION ALL SELECT 'ETL run', 'PASS'"
    f" UNION ALL SELECT 'Fact sanity checks', CASE WHEN (SELECT count(*) FROM fact_price WHERE price < 0) + {_total_pairs('fact_price', 'price_hist_id', 'effective_start', 'effective_end', '<')} = 0 THEN 'PASS' ELSE 'FAIL' END"
    f" UNION ALL SELECT 'Data quality checks', {_overall(_check_rows())}"
    f" UNION ALL SELECT 'OVERALL', CASE WHEN (SELECT min(status) FROM ({_thresholds(list(THRESHOLDS))})) = 'PASS' AND {_overall(_check_rows())} = 'PASS'"
    f" AND (SELECT count(*) FROM fact_price WHERE price < 0) + {_total_pairs('fact_price', 'price_hist_id', 'effective_start', 'effective_end', '<')} = 0 THEN 'PASS' ELSE 'FAIL' END",
    "override_demo": f"SELECT price_hist_id, {K}, CAST(price + 1 AS DOUBLE) AS old_price, CAST(price + 6.5 AS DOUBLE) AS new_price, 'pricing desk' AS changed_by,"
    " '2001-08-02 00:00:00' AS changed_at FROM fact_price WHERE price_hist_id = (SELECT min(price_hist_id) FROM fact_price WHERE effective_end IS NULL)",
    "override_defaults": f"SELECT price_hist_id, 'string' AS by_type, TRUE AS by_known, 'timestamp' AS at_type, TRUE AS at_known FROM ({_OVERRIDES})",
    "stream_refresh": "SELECT region_code, channel_code, CAST(count(*) AS BIGINT) AS row_count, CAST(count(*) FILTER (effective_end IS NULL) AS BIGINT) AS open_rows,"
    " CAST(sum(price) AS DOUBLE) AS total_price, CAST(sum(effective_end - effective_start) AS BIGINT) AS closed_days, TRUE AS stamped FROM fact_price GROUP BY region_code, channel_code",
    "late_arrivals": f"SELECT 'price' AS kind, {K}, effective_start AS on_date, CAST(price AS DOUBLE) AS amount, CAST({AS_OF} - effective_start AS INTEGER) AS days_late"
    f" FROM stg_price WHERE {AS_OF} - effective_start >= 30 UNION ALL SELECT 'sale', {K}, sale_date, CAST(net_sales AS DOUBLE), CAST({AS_OF} - sale_date AS INTEGER)"
    f" FROM stg_sales WHERE {AS_OF} - sale_date >= 30",
    "late_repair": f"SELECT a.price_hist_id, {', '.join('a.' + c for c in K.split(', '))}, a.effective_start, a.effective_end AS end_with_late, b.effective_end AS end_without_late"
    f" FROM fact_price a JOIN ({_repaired('(SELECT * FROM price_new WHERE source_system <> ' + chr(39) + 'LATE_LOAD_SYS' + chr(39) + ')')}) b"
    " ON a.price_hist_id = b.price_hist_id WHERE a.effective_end IS DISTINCT FROM b.effective_end",
}

ORACLES: dict[str, str] = {name: _with(select) for name, select in _QUERIES.items()}
