"""Plain-SQL twins of the registered queries, for DuckDB.

The driver registers the input tables as views and runs these next to the
Spark queries.  Each builder returns one SQL string whose output columns
(names and types) match the Spark query.  Only standard SQL plus DuckDB's
date functions are used.
"""

from __future__ import annotations

from .functions.labels import (CUBE_LEVEL_FALLBACK, CUBE_LEVEL_LABELS,
                               GROUPING_SET_FALLBACK, GROUPING_SET_LABELS, TOTAL_LABEL)
from .model import resolve_levels

ARTICLE = ("p.p_type || '/' || p.p_brand || '/' || p.p_name || '#' || "
           "CAST(p.p_partkey AS VARCHAR)")
GROUP = "p.p_type || '/' || p.p_brand || '/' || p.p_name"
FAMILY = "p.p_type || '/' || p.p_brand"

DATE_KEY = ("CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + "
            "day(o.o_orderdate) AS INTEGER)")


def star_cte(year: int | None = None, name: str = "star") -> str:
    where = f"WHERE year(o.o_orderdate) = {int(year)}" if year is not None else ""
    return f"""{name} AS (
  SELECT
    {DATE_KEY} AS date_key,
    CAST(o.o_orderdate AS DATE) AS full_date,
    CAST(year(o.o_orderdate) AS INTEGER) AS "year",
    CAST(quarter(o.o_orderdate) AS INTEGER) AS "quarter",
    CAST(month(o.o_orderdate) AS INTEGER) AS "month",
    CAST(day(o.o_orderdate) AS INTEGER) AS "day",
    l.l_suppkey AS shop_key,
    s.s_name AS shop_name,
    n.n_name AS city_name,
    r.r_name AS region_name,
    'WORLD' AS country_name,
    l.l_partkey AS product_key,
    {ARTICLE} AS article_name,
    {GROUP} AS product_group_name,
    {FAMILY} AS product_family_name,
    p.p_type AS product_category_name,
    CAST(l.l_quantity AS INTEGER) AS quantity_sold,
    CAST(l.l_extendedprice AS DECIMAL(10,2)) AS revenue
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  {where}
)"""


def _q(col: str) -> str:
    return f'"{col}"'


def _label_case(g: str, t: str, p: str, labels: dict, fallback: str) -> str:
    whens = "\n".join(
        f"    WHEN GROUPING({g}) = {a} AND GROUPING({t}) = {b} AND GROUPING({p}) = {c} "
        f"THEN '{text}'" for (a, b, c), text in labels.items())
    return f"CASE\n{whens}\n    ELSE '{fallback}' END"


def ratio_sql(revenue: str = "revenue", quantity: str = "quantity_sold") -> str:
    """Per-row unit price in units of 1e-8, rounded half away from zero."""
    cents = f"CAST({revenue} * 100 AS BIGINT)"
    mag = f"((abs({cents}) * 1000000 + abs({quantity}) // 2) // abs({quantity}))"
    return (f"(CASE WHEN {quantity} = 0 OR {quantity} IS NULL OR {revenue} IS NULL THEN NULL "
            f"WHEN ({cents} < 0) <> ({quantity} < 0) THEN -{mag} ELSE {mag} END)")


def mean_price_sql(ratio: str) -> str:
    s, n = f"SUM({ratio})", f"COUNT({ratio})"
    units = f"((abs({s}) + 50 * {n}) // (100 * {n}))"
    return (f"CASE WHEN {n} = 0 THEN NULL ELSE CAST(CASE WHEN {s} < 0 THEN -{units} "
            f"ELSE {units} END AS DOUBLE) / CAST(1000000 AS DOUBLE) END")


MEASURES_SQL = f"""CAST(SUM(quantity_sold) AS BIGINT) AS total_quantity,
  CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_revenue,
  CAST(COUNT(*) AS BIGINT) AS transaction_count,
  {mean_price_sql(ratio_sql())} AS avg_unit_price"""


def _levels_select(cols: tuple[str, str, str], label_name: str, labels: dict,
                   fallback: str) -> str:
    g, t, p = (_q(c) for c in cols)
    dims = ",\n  ".join(
        f"CASE WHEN GROUPING({c}) = 1 THEN '{TOTAL_LABEL}' ELSE CAST({c} AS VARCHAR) END "
        f"AS {d}" for c, d in zip((g, t, p), ("geo_dimension", "time_dimension",
                                              "product_dimension")))
    flags = ",\n  ".join(
        f"CAST(GROUPING({c}) AS INTEGER) AS {f}"
        for c, f in zip((g, t, p), ("geo_grouping", "time_grouping", "product_grouping")))
    return (f"SELECT\n  {dims},\n  {flags},\n  {MEASURES_SQL},\n  "
            f"{_label_case(g, t, p, labels, fallback)} AS {label_name}")


def cube_sql(geo: str, time: str, product: str, year: int | None = None,
             source: str | None = None) -> str:
    cols = resolve_levels(geo, time, product)
    g, t, p = (_q(c) for c in cols)
    with_clause = f"WITH {source or star_cte(year)}"
    return (f"{with_clause}\n{_levels_select(cols, 'aggregation_level', CUBE_LEVEL_LABELS, CUBE_LEVEL_FALLBACK)}\n"
            f"FROM star\nGROUP BY CUBE ({g}, {t}, {p})")


def grouping_sets_sql(geo: str, time: str, product: str, year: int | None = None) -> str:
    cols = resolve_levels(geo, time, product)
    g, t, p = (_q(c) for c in cols)
    return (f"WITH {star_cte(year)}\n"
            f"{_levels_select(cols, 'aggregation_type', GROUPING_SET_LABELS, GROUPING_SET_FALLBACK)}\n"
            f"FROM star\nGROUP BY GROUPING SETS (({g}, {t}, {p}), ({g}, {t}), ({g}, {p}), ({g}), ())")


def wrap(inner: str, outer: str) -> str:
    """Use a full query as the relation ``r`` of an outer query."""
    return f"WITH r AS (\n{inner}\n)\n{outer}"


# -- dimensions ---------------------------------------------------------------

def dim_date_sql(extra_years: int = 0) -> str:
    return f"""WITH bounds AS (
  SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) + {int(extra_years)} AS hi
  FROM orders),
days AS (
  SELECT CAST(unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31),
                                     INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM bounds WHERE lo IS NOT NULL)
SELECT
  CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key,
  full_date,
  CAST(year(full_date) AS INTEGER) AS "year",
  CAST(quarter(full_date) AS INTEGER) AS "quarter",
  CAST(month(full_date) AS INTEGER) AS "month",
  CAST(day(full_date) AS INTEGER) AS "day",
  CAST(isodow(full_date) AS INTEGER) AS day_of_week,
  monthname(full_date) AS month_name,
  'Q' || CAST(quarter(full_date) AS VARCHAR) AS quarter_name
FROM days"""


DIM_SHOP_SQL = """SELECT s.s_suppkey AS shop_key, s.s_suppkey AS shop_id, s.s_name AS shop_name,
  CAST(n.n_nationkey AS INTEGER) AS city_id, n.n_name AS city_name,
  CAST(r.r_regionkey AS INTEGER) AS region_id, r.r_name AS region_name,
  1 AS country_id, 'WORLD' AS country_name
FROM supplier s
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

DIM_PRODUCT_SQL = f"""SELECT p.p_partkey AS product_key, p.p_partkey AS article_id,
  {ARTICLE} AS article_name,
  CAST(p.p_retailprice AS DECIMAL(10,2)) AS price,
  {GROUP} AS product_group_name,
  {FAMILY} AS product_family_name,
  p.p_type AS product_category_name
FROM part p"""

DIM_SHOP_CHAIN_SQL = """SELECT s.s_suppkey AS shop_key, CAST(s.s_suppkey AS INTEGER) AS shop_id,
  s.s_name AS shop_name, CAST(n.n_nationkey AS INTEGER) AS city_id, n.n_name AS city_name,
  CAST(r.r_regionkey AS INTEGER) AS region_id, r.r_name AS region_name,
  1 AS country_id, 'WORLD' AS country_name
FROM supplier s
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

DIM_PRODUCT_CHAIN_SQL = f"""SELECT p.p_partkey AS product_key,
  CAST(p.p_partkey AS INTEGER) AS article_id, {ARTICLE} AS article_name,
  CAST(p.p_retailprice AS DECIMAL(10,2)) AS price,
  CAST(min(p.p_partkey) OVER (PARTITION BY p_type, p_brand, p_name) AS INTEGER) AS product_group_id,
  {GROUP} AS product_group_name,
  CAST(min(p.p_partkey) OVER (PARTITION BY p_type, p_brand) AS INTEGER) AS product_family_id,
  {FAMILY} AS product_family_name,
  CAST(min(p.p_partkey) OVER (PARTITION BY p_type) AS INTEGER) AS product_category_id,
  p.p_type AS product_category_name
FROM part p"""

FACT_SQL = f"""SELECT {DATE_KEY} AS date_key, l.l_suppkey AS shop_key, l.l_partkey AS product_key,
  CAST(l.l_quantity AS INTEGER) AS quantity_sold,
  CAST(l.l_extendedprice AS DECIMAL(10,2)) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def ctes(**named: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS (\n{v}\n)" for k, v in named.items())


# -- sales text and load ---------------------------------------------------------

_SALES_TEXT = f"""SELECT
  CASE WHEN h % 101 = 7 THEN '31.02.' || CAST(year(d) AS VARCHAR)
       WHEN h % 103 = 5 THEN strftime(d, '%d.%m.') || CAST(year(d) + 40 AS VARCHAR)
       WHEN h % 7 = 3 THEN CAST(day(d) AS VARCHAR) || '.' || CAST(month(d) AS VARCHAR) || '.'
                           || CAST(year(d) AS VARCHAR)
       ELSE strftime(d, '%d.%m.%Y') END AS "Date",
  CASE WHEN h % 107 = 11 THEN shop_name || ' X' ELSE shop_name END AS "Shop",
  CASE WHEN h % 109 = 13 THEN 'X' || article_name ELSE article_name END AS "Article",
  CASE WHEN h % 113 = 17 THEN ''
       WHEN h % 127 = 19 THEN '0'
       WHEN h % 11 = 4 THEN ' ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' '
       ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS "Sold",
  CASE WHEN h % 131 = 23 THEN '1.' || amt
       WHEN h % 137 = 29 THEN amt || '5'
       ELSE amt END AS "Revenue"{{located}}
FROM (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
         l.l_orderkey * 8 + l.l_linenumber AS h, CAST(o.o_orderdate AS DATE) AS d,
         s.s_name AS shop_name, {ARTICLE} AS article_name, l.l_quantity,
         replace(CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(10,2)) AS DECIMAL(18,2)) AS VARCHAR),
                 '.', ',') AS amt
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
) lines"""
SALES_TEXT_SQL = _SALES_TEXT.format(located="")
# One file a year, its lines in key order below the header.
LOCATED_TEXT_SQL = _SALES_TEXT.format(located=""",
  'y=' || CAST(year(d) AS VARCHAR) AS source_file,
  1 + row_number() OVER (PARTITION BY year(d) ORDER BY l_orderkey, l_linenumber,
                             l_partkey, l_suppkey, l_extendedprice) AS source_line""")

CLASSIFIED_SQL = """SELECT x.*,
  CASE WHEN x.sale_date IS NULL THEN 'bad_date'
       WHEN sh.shop_key IS NULL THEN 'unknown_shop'
       WHEN ar.product_key IS NULL THEN 'unknown_article'
       WHEN x.sale_revenue IS NULL THEN 'bad_revenue'
       WHEN x.sold_quantity IS NULL THEN 'bad_sold'
       WHEN c.date_key IS NULL THEN 'date_out_of_range' END AS reject_reason,
  sh.shop_key, ar.product_key
FROM (
  SELECT t.*,
    CAST(try_strptime(trim(t."Date"), '%d.%m.%Y') AS DATE) AS sale_date,
    CAST(year(CAST(try_strptime(trim(t."Date"), '%d.%m.%Y') AS DATE)) * 10000
         + month(CAST(try_strptime(trim(t."Date"), '%d.%m.%Y') AS DATE)) * 100
         + day(CAST(try_strptime(trim(t."Date"), '%d.%m.%Y') AS DATE)) AS INTEGER) AS sale_date_key,
    CASE WHEN regexp_matches(trim(t."Sold"), '^[+-]?[0-9]+$')
         THEN TRY_CAST(trim(t."Sold") AS INTEGER) END AS sold_quantity,
    TRY_CAST(replace(trim(t."Revenue"), ',', '.') AS DECIMAL(10,2)) AS sale_revenue
  FROM sales_text t) x
LEFT JOIN (SELECT shop_name, max(shop_key) AS shop_key FROM dim_shop GROUP BY shop_name) sh
  ON x."Shop" = sh.shop_name
LEFT JOIN (SELECT article_name, max(product_key) AS product_key FROM dim_product
           GROUP BY article_name) ar
  ON x."Article" = ar.article_name
LEFT JOIN dim_date c ON c.date_key = x.sale_date_key"""


def load_ctes() -> dict[str, str]:
    return {"dim_date": dim_date_sql(), "dim_shop": DIM_SHOP_SQL,
            "dim_product": DIM_PRODUCT_SQL, "sales_text": SALES_TEXT_SQL,
            "classified": CLASSIFIED_SQL}


PARSED_STAR_SQL = """SELECT f.sale_date_key AS date_key, c.full_date, c."year", c."quarter", c."month", c."day",
  f.shop_key, sh.shop_name, sh.city_name, sh.region_name, sh.country_name,
  f.product_key, pr.article_name, pr.product_group_name, pr.product_family_name,
  pr.product_category_name, f.sold_quantity AS quantity_sold, f.sale_revenue AS revenue
FROM classified f
JOIN dim_date c ON f.sale_date_key = c.date_key
JOIN dim_shop sh ON f.shop_key = sh.shop_key
JOIN dim_product pr ON f.product_key = pr.product_key
WHERE f.reject_reason IS NULL"""


def cube_over(named: dict[str, str], geo: str, time: str, product: str) -> str:
    cols = resolve_levels(geo, time, product)
    g, t, p = (_q(c) for c in cols)
    return (f"{ctes(**named)}\n"
            f"{_levels_select(cols, 'aggregation_level', CUBE_LEVEL_LABELS, CUBE_LEVEL_FALLBACK)}\n"
            f"FROM star\nGROUP BY CUBE ({g}, {t}, {p})")


# -- single CUBE level, navigation helpers ----------------------------------------

def cube_level_sql(level: str, geo: str, time: str, product: str, year: int | None) -> str:
    return wrap(cube_sql(geo, time, product, year),
                f"SELECT * FROM r WHERE aggregation_level = '{level}'")


# -- cross table ---------------------------------------------------------------------

_METRIC_SQL = {"total_quantity": ("CAST(quantity_sold AS BIGINT)", "BIGINT"),
               "total_revenue": ("revenue", "DECIMAL(38,2)"),
               "transaction_count": ("CAST(1 AS BIGINT)", "BIGINT")}


def _crosstab_labels(time: str, year: int | None) -> str:
    suffix = "" if year is None else f" || ', {year}'"
    return f"""CASE WHEN GROUPING(_g) = 1 THEN 'total' ELSE _g END AS geo_region,
  CASE WHEN GROUPING(_g) = 1 THEN '' WHEN GROUPING(_t) = 1 THEN 'total'
       ELSE '{time} ' || _t{suffix} END AS time_period"""


def _crosstab_cells(geo: str, time: str, product: str, year: int | None, metric: str,
                    source: dict | None) -> str:
    g, t, p = resolve_levels(geo, time, product)
    value, _ = _METRIC_SQL[metric]
    star = ctes(**source)[5:] if source else star_cte(year)
    return (f"WITH {star},\ncells AS (SELECT CAST({_q(g)} AS VARCHAR) AS _g, "
            f"CAST({_q(t)} AS VARCHAR) AS _t, CAST({_q(p)} AS VARCHAR) AS _p, "
            f"SUM({value}) AS _v FROM star GROUP BY 1, 2, 3)")


def crosstab_sql(geo: str, time: str, product: str, year: int | None, metric: str,
                 source: dict | None = None) -> str:
    """Long form: plain GROUPING SETS over the cells."""
    return f"""{_crosstab_cells(geo, time, product, year, metric, source)}
SELECT {_crosstab_labels(time, year)},
  CASE WHEN GROUPING(_p) = 1 THEN 'TOTAL' ELSE _p END AS product_member,
  CAST(SUM(_v) AS {_METRIC_SQL[metric][1]}) AS value,
  CAST(GROUPING(_g) AS INTEGER) AS geo_total, CAST(GROUPING(_t) AS INTEGER) AS time_total,
  CAST(GROUPING(_p) AS INTEGER) AS product_total
FROM cells
GROUP BY GROUPING SETS ((_g, _t, _p), (_g, _t), (_g, _p), (_g), (_p), ())"""


def crosstab_wide_sql(members: list[str], geo: str, time: str, product: str, year: int | None,
                      metric: str, rest: bool = False) -> str:
    """Wide form: one literal CASE per named member, one for the ``rest``."""
    typ = _METRIC_SQL[metric][1]
    columns = ",\n  ".join(
        f"CAST(COALESCE(SUM(CASE WHEN _p = '{m}' THEN _v END), 0) AS {typ}) AS {_q(m)}"
        for m in members)
    if rest:
        named = ", ".join(f"'{m}'" for m in members)
        columns += (f",\n  CAST(COALESCE(SUM(CASE WHEN _p IS NULL OR _p NOT IN ({named}) THEN _v END), 0) "
                    f"AS {typ}) AS \"...\"")
    return f"""{_crosstab_cells(geo, time, product, year, metric, None)}
SELECT {_crosstab_labels(time, year)},
  {columns},
  CAST(COALESCE(SUM(_v), 0) AS {typ}) AS "TOTAL"
FROM cells GROUP BY ROLLUP (_g, _t)"""


def insights_sql(geo: str, time: str, product: str, year: int | None, metric: str, top: int = 3) -> str:
    g, _, _ = resolve_levels(geo, time, product)
    value, typ = _METRIC_SQL[metric]
    return f"""WITH {star_cte(year)},
per_geo AS (SELECT CAST({_q(g)} AS VARCHAR) AS _g, SUM({value}) AS _v FROM star GROUP BY 1)
SELECT * FROM (SELECT 'geographic_total' AS insight, _g AS label, CAST(_v AS {typ}) AS value
               FROM per_geo ORDER BY _g LIMIT {int(top)})
UNION ALL
SELECT 'grand_total' AS insight, 'total' AS label, CAST(SUM(_v) AS {typ}) AS value FROM per_geo"""


def shape_sql(geo: str, time: str, product: str, year: int | None) -> str:
    g, t, p = resolve_levels(geo, time, product)
    return f"""WITH {star_cte(year)},
cells AS (SELECT DISTINCT {_q(g)} AS _g, {_q(t)} AS _t, {_q(p)} AS _p FROM star),
c AS (SELECT (SELECT count(*) FROM (SELECT DISTINCT _g FROM cells)) AS geo_members,
             (SELECT count(*) FROM (SELECT DISTINCT _t FROM cells)) AS time_periods,
             (SELECT count(*) FROM (SELECT DISTINCT _p FROM cells)) AS product_members,
             (SELECT count(*) FROM (SELECT DISTINCT _g, _t FROM cells)) AS pairs)
SELECT geo_members, time_periods, product_members,
       pairs + geo_members + 1 AS table_rows, product_members + 1 AS table_columns
FROM c"""
