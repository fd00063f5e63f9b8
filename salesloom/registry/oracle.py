"""SQL for the comparison engine: the star schema as CTEs over the given tables."""

from __future__ import annotations

MISSING = "_dbt_utils_surrogate_key_null_"


def ratio(n: str, d: str, factor: str = "1.0") -> str:
    return (
        f"round(CAST(CAST({n} AS DOUBLE) * CAST({factor} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0) "
        f"AS DECIMAL(38,10)), 2)::DOUBLE"
    )


def pct(n: str, d: str) -> str:
    return ratio(n, d, "100.0")


def growth(current: str, previous: str) -> str:
    return pct(f"({current} - {previous})", previous)


def quotient(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0))"


def hashed(*columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{MISSING}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def reaches(n: str, d: str, above: int, below: int) -> str:
    """Whether n / d >= above / below, on exact decimals."""
    return f"(({d} > 0 AND ({n}) * {below} >= ({d}) * {above}) OR ({d} < 0 AND ({n}) * {below} <= ({d}) * {above}))"


def margin_class(profit: str, net: str) -> str:
    return (
        f"CASE WHEN {reaches(profit, net, 1, 5)} THEN 'High Margin' WHEN {reaches(profit, net, 1, 10)} "
        f"THEN 'Medium Margin' WHEN {reaches(profit, net, 0, 1)} THEN 'Low Margin' ELSE 'Loss Making' END"
    )


def effect_class(profit: str, discounts: str) -> str:
    return (
        f"CASE WHEN {profit} <= 0 THEN 'Loss Making' WHEN {reaches(profit, discounts, 3, 1)} THEN 'Highly Effective' "
        f"WHEN {reaches(profit, discounts, 1, 1)} THEN 'Effective' ELSE 'Ineffective' END"
    )


def sums(prefix: str = "") -> str:
    """The six totals and the transaction count, undecorated decimals."""
    p = prefix
    return (
        f"sum({p}gross_sales) AS gross_sales, sum({p}discounts) AS total_discounts, "
        f"sum({p}net_sales) AS net_sales, sum({p}cogs) AS total_cogs, sum({p}profit) AS total_profit, "
        f"sum({p}units_sold) AS units_sold, count(DISTINCT {p}transaction_id) AS transaction_count"
    )


SUM_NAMES = ("gross_sales", "total_discounts", "net_sales", "total_cogs", "total_profit", "units_sold")


def doubles(*columns: str, prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{c} AS DOUBLE) AS {c}" for c in columns)


MONEY = doubles(*SUM_NAMES)

_LINES = f"""
priced AS (
  SELECT c_mktsegment AS segment_name, n_name AS country_name, p_name AS product_name,
    CASE WHEN CAST(l_discount AS DECIMAL(4,2)) <= 0 THEN 'None'
         WHEN CAST(l_discount AS DECIMAL(4,2)) <= 0.03 THEN 'Low'
         WHEN CAST(l_discount AS DECIMAL(4,2)) <= 0.07 THEN 'Medium' ELSE 'High' END AS discount_band,
    CAST(l_quantity AS DECIMAL(18,2)) AS units_sold,
    CAST(p_retailprice AS DECIMAL(18,2)) AS manufacturing_price,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS gross_sales,
    CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
         AS DECIMAL(18,2)) AS discounts,
    CAST(l_shipdate AS DATE) AS transaction_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
),
lines AS MATERIALIZED (
  SELECT *, CAST(net_sales - cogs AS DECIMAL(18,2)) AS profit,
    CAST(month(transaction_date) AS INTEGER) AS month_number,
    strftime(transaction_date, '%B') AS month_name,
    CAST(year(transaction_date) AS INTEGER) AS year,
    'lineitem' AS record_source
  FROM (
    SELECT *, CAST(round(CAST(gross_sales::DOUBLE / nullif(units_sold::DOUBLE, 0) AS DECIMAL(38,10)), 2)
                   AS DECIMAL(18,2)) AS sale_price,
      CAST(gross_sales - discounts AS DECIMAL(18,2)) AS net_sales,
      CAST(round(units_sold * manufacturing_price, 2) AS DECIMAL(18,2)) AS cogs
    FROM priced)
)"""


def _dim_date(start: str, last: str) -> str:
    return f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day,
    CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
    CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
    CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_number,
    strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(year(d) AS INTEGER) AS year, dayofweek(d) >= 5 AS is_weekend, false AS is_holiday,
    day(d) = 1 AS is_first_day_of_month, d = last_day(d) AS is_last_day_of_month
  FROM (SELECT CAST(unnest(generate_series(DATE '{start}', DATE '{last}', INTERVAL 1 DAY)) AS DATE) AS d)"""


_DIMS = """
dim_segment AS (
  SELECT row_number() OVER (ORDER BY segment_name) AS segment_key, segment_name,
    'Business segment for ' || segment_name AS segment_description
  FROM (SELECT DISTINCT segment_name FROM lines WHERE segment_name IS NOT NULL)
),
product_versions AS (
  SELECT product_name, manufacturing_price, min(transaction_date) AS effective_date
  FROM lines WHERE product_name IS NOT NULL GROUP BY 1, 2
),
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_name, effective_date, manufacturing_price) AS product_key, *,
    end_date = DATE '9999-12-30' AS is_current
  FROM (
    SELECT *, CAST(lead(effective_date, 1, DATE '9999-12-31') OVER (
        PARTITION BY product_name ORDER BY effective_date, manufacturing_price)
      - INTERVAL 1 DAY AS DATE) AS end_date
    FROM product_versions)
),
dim_geography AS (
  SELECT row_number() OVER (ORDER BY country_name) AS geography_key, country_name,
    coalesce(r_name, 'Other') AS region, coalesce(r_name, 'Other') AS sub_region
  FROM (SELECT DISTINCT country_name FROM lines WHERE country_name IS NOT NULL)
  LEFT JOIN nation ON country_name = n_name LEFT JOIN region ON n_regionkey = r_regionkey
),
dim_discount AS (
  SELECT row_number() OVER (ORDER BY discount_band) AS discount_key, discount_band,
    CASE discount_band WHEN 'Low' THEN 1 WHEN 'Medium' THEN 15 WHEN 'High' THEN 30 ELSE 0 END
      AS discount_range_min,
    CASE discount_band WHEN 'Low' THEN 15 WHEN 'Medium' THEN 30 WHEN 'High' THEN 50 ELSE 0 END
      AS discount_range_max,
    CASE discount_band WHEN 'None' THEN 'No discount applied'
      WHEN 'Low' THEN 'Small discount between 1-15%'
      WHEN 'Medium' THEN 'Medium discount between 15-30%'
      WHEN 'High' THEN 'High discount between 30-50%' ELSE 'Unknown discount type' END
      AS discount_description
  FROM (SELECT DISTINCT discount_band FROM lines WHERE discount_band IS NOT NULL)
)"""


def _fact(calendar: str) -> str:
    row_id = hashed(
        "l.transaction_date", "l.product_name", "l.segment_name", "l.country_name", "l.discount_band",
        "l.units_sold",
    )
    return f"""
  SELECT {row_id} AS transaction_id, dd.date_key, p.product_key, s.segment_key, g.geography_key,
    b.discount_key, l.units_sold, l.sale_price, l.gross_sales, l.discounts, l.net_sales, l.cogs,
    coalesce(l.profit, l.net_sales - l.cogs) AS profit, l.transaction_date, l.record_source,
    (dd.date_key IS NULL OR p.product_key IS NULL OR s.segment_key IS NULL
      OR g.geography_key IS NULL OR b.discount_key IS NULL) AS has_missing_keys
  FROM lines l LEFT JOIN {calendar} dd ON l.transaction_date = dd.date_day
  LEFT JOIN dim_product p ON l.product_name = p.product_name AND p.is_current
  LEFT JOIN dim_segment s ON l.segment_name = s.segment_name
  LEFT JOIN dim_geography g ON l.country_name = g.country_name
  LEFT JOIN dim_discount b ON l.discount_band = b.discount_band"""


_CLEAN = "clean AS (SELECT * FROM fact WHERE NOT has_missing_keys)"
_HEAD = f"WITH {_LINES},\ndim_date AS ({_dim_date('1995-01-01', '2001-12-31')}\n),{_DIMS}"


def on_lines(body: str) -> str:
    """SQL over the staged sales lines."""
    return f"WITH {_LINES}\n{body}"


def on_star(body: str) -> str:
    """SQL over lines, the five dimensions, ``fact`` and ``clean`` (resolved fact rows)."""
    return f"{_HEAD},\nfact AS MATERIALIZED ({_fact('dim_date')}\n),\n{_CLEAN}\n{body}"


def on_short_star(body: str) -> str:
    """The same with a calendar that ends on 2000-06-30."""
    head = f"WITH {_LINES},\ndim_date AS ({_dim_date('1995-01-01', '2000-06-30')}\n),{_DIMS}"
    return f"{head},\nfact AS MATERIALIZED ({_fact('dim_date')}\n),\n{_CLEAN}\n{body}"
