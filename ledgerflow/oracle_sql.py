"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement re-derives the star tables from the test tables, runs the
same cleaning and join rules in plain SQL, and computes the same output
columns.  Shared CTE text is built by the functions below.
"""

from __future__ import annotations


def _star(dirty: bool) -> str:
    k = "l.l_orderkey"
    rev = ("CAST(l.l_extendedprice AS DECIMAL(12,2)) * "
           "(CAST(1 AS DECIMAL(3,2)) - CAST(l.l_discount AS DECIMAL(3,2)))")
    cost = ("CAST(l.l_extendedprice AS DECIMAL(12,2)) * "
            "(CAST(0.5 AS DECIMAL(3,2)) + CAST(l.l_tax AS DECIMAL(3,2)))")
    company = "CAST(l.l_suppkey AS VARCHAR)"
    item = "CAST(l.l_partkey AS VARCHAR)"
    invoice = "strftime(l.l_shipdate, '%Y%m%d')"
    area = "CAST(c_nationkey AS VARCHAR)"
    country = "c_mktsegment"
    if dirty:
        company = f"CASE WHEN {k} % 53 <> 0 THEN {company} END"
        item = (f"CASE WHEN {k} % 61 <> 0 THEN {item} WHEN l.l_linenumber = 1 THEN '99999999' "
                f"ELSE '-1' END")
        invoice = (f"CASE WHEN {k} % 67 = 0 THEN '27881231' WHEN {k} % 71 = 0 THEN '20251345' "
                   f"ELSE {invoice} END")
        rev = f"CASE WHEN {k} % 73 <> 0 THEN {rev} END"
        area = (f"CASE WHEN c_custkey % 59 = 0 THEN NULL WHEN c_custkey % 47 = 0 "
                f"THEN CAST(c_nationkey + 1000 AS VARCHAR) ELSE {area} END")
        country = "CASE WHEN c_custkey % 43 <> 0 THEN c_mktsegment END"
    sales_sel = f"""SELECT {company} AS ID_COMPANY, CAST({k} AS VARCHAR) AS ID_ORDER_NUM,
         CAST(o.o_custkey AS VARCHAR) AS IDS_CUSTOMER, {item} AS IDS_ITEM,
         strftime(o.o_orderdate, '%Y%m%d') AS ID_ORDER_DATE, {invoice} AS ID_INVOICE_DATE,
         {rev} AS VAL_REVENUES, {cost} AS VAL_COST
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
    sales = sales_sel + (f"\n  UNION ALL\n  {sales_sel} WHERE {k} % 100 = 0" if dirty else "")
    item_src = "SELECT CAST(p_partkey AS VARCHAR) AS IDS_ITEM, p_name AS DESC_ITEM, p_type AS ID_BUSINESS_LINE FROM part"
    if dirty:
        item_src += ("\n  UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name || ' B', p_type FROM part "
                     "WHERE p_partkey % 37 = 0")
    return f"""sales_src AS (
  {sales}),
customer_src AS (SELECT CAST(c_custkey AS VARCHAR) AS IDS_CUSTOMER, c_name AS DESC_CUSTOMER,
  {country} AS ID_COUNTRY, {area} AS ID_AREA_MANAGER FROM customer),
item_src AS ({item_src}),
company_src AS (SELECT CAST(s_suppkey AS VARCHAR) AS ID_COMPANY, s_name AS DESC_COMPANY FROM supplier),
area_src AS (SELECT CAST(n_nationkey AS VARCHAR) AS ID_AREA_MANAGER, n_name AS DESC_AREA_MANAGER FROM nation),
bl_src AS (SELECT DISTINCT p_type AS ID_BUSINESS_LINE, 'BL ' || p_type AS DESC_BUSINESS_LINE FROM part)"""


def _pk(name: str, src: str, pk: str, others: list[str]) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in others)
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {pk} ORDER BY {order}) AS rn
    FROM (SELECT DISTINCT * FROM {src}) WHERE {pk} IS NOT NULL) WHERE rn = 1)"""


def parse_date(x: str) -> str:
    return (f"CAST(coalesce(try_strptime(trim({x}), '%Y%m%d'), try_strptime(trim({x}), '%Y-%m-%d')) AS DATE)")


def etl_ctes(dirty: bool = False) -> str:
    """CTEs up to ``olap``: the cleaned, joined table with calendar columns
    (money still exact decimals)."""
    return f"""WITH {_star(dirty)},
sales_d AS (SELECT DISTINCT * FROM sales_src),
{_pk('company_pk', 'company_src', 'ID_COMPANY', ['DESC_COMPANY'])},
{_pk('customer_pk', 'customer_src', 'IDS_CUSTOMER', ['DESC_CUSTOMER', 'ID_COUNTRY', 'ID_AREA_MANAGER'])},
{_pk('item_pk', 'item_src', 'IDS_ITEM', ['DESC_ITEM', 'ID_BUSINESS_LINE'])},
{_pk('area_pk', 'area_src', 'ID_AREA_MANAGER', ['DESC_AREA_MANAGER'])},
{_pk('bl_pk', 'bl_src', 'ID_BUSINESS_LINE', ['DESC_BUSINESS_LINE'])},
sales_fk1 AS (SELECT * FROM sales_d WHERE ID_COMPANY IS NOT NULL
  AND ID_COMPANY IN (SELECT ID_COMPANY FROM company_pk)),
sales_fk2 AS (SELECT * FROM sales_fk1 WHERE IDS_CUSTOMER IS NOT NULL
  AND IDS_CUSTOMER IN (SELECT IDS_CUSTOMER FROM customer_pk)),
sales_fk AS (SELECT * FROM sales_fk2 WHERE IDS_ITEM IS NOT NULL
  AND IDS_ITEM IN (SELECT IDS_ITEM FROM item_pk)),
customer_fk AS (SELECT * FROM customer_pk WHERE ID_AREA_MANAGER IS NOT NULL
  AND ID_AREA_MANAGER IN (SELECT ID_AREA_MANAGER FROM area_pk)),
item_fk AS (SELECT * FROM item_pk WHERE ID_BUSINESS_LINE IS NOT NULL
  AND ID_BUSINESS_LINE IN (SELECT ID_BUSINESS_LINE FROM bl_pk)),
sales_dt AS (SELECT * REPLACE ({parse_date('ID_ORDER_DATE')} AS ID_ORDER_DATE,
                               {parse_date('ID_INVOICE_DATE')} AS ID_INVOICE_DATE) FROM sales_fk),
sales_ok AS (SELECT *, VAL_REVENUES - VAL_COST AS VAL_MARGIN FROM sales_dt
  WHERE ID_ORDER_DATE IS NOT NULL AND ID_INVOICE_DATE IS NOT NULL
    AND VAL_REVENUES IS NOT NULL AND VAL_COST IS NOT NULL),
olap AS (
  SELECT s.ID_COMPANY, s.ID_ORDER_NUM, s.IDS_CUSTOMER, s.IDS_ITEM, s.ID_ORDER_DATE, s.ID_INVOICE_DATE,
         s.VAL_REVENUES, s.VAL_COST, s.VAL_MARGIN, co.DESC_COMPANY,
         cu.DESC_CUSTOMER, cu.ID_COUNTRY, cu.ID_AREA_MANAGER, am.DESC_AREA_MANAGER,
         it.DESC_ITEM, it.ID_BUSINESS_LINE, bl.DESC_BUSINESS_LINE,
         CAST(year(s.ID_ORDER_DATE) AS INTEGER) AS ORDER_YEAR,
         CAST(month(s.ID_ORDER_DATE) AS INTEGER) AS ORDER_MONTH,
         CAST(weekofyear(s.ID_ORDER_DATE) AS INTEGER) AS ORDER_WEEK
  FROM sales_ok s
  LEFT JOIN company_pk co ON s.ID_COMPANY = co.ID_COMPANY
  LEFT JOIN customer_fk cu ON s.IDS_CUSTOMER = cu.IDS_CUSTOMER
  LEFT JOIN area_pk am ON cu.ID_AREA_MANAGER = am.ID_AREA_MANAGER
  LEFT JOIN item_fk it ON s.IDS_ITEM = it.IDS_ITEM
  LEFT JOIN bl_pk bl ON it.ID_BUSINESS_LINE = bl.ID_BUSINESS_LINE)"""


OLAP_DOUBLE = """SELECT * REPLACE (CAST(VAL_REVENUES AS DOUBLE) AS VAL_REVENUES,
  CAST(VAL_COST AS DOUBLE) AS VAL_COST, CAST(VAL_MARGIN AS DOUBLE) AS VAL_MARGIN) FROM olap"""


def _totals(keys: str, money: str = "DOUBLE") -> str:
    return f"""SELECT {keys},
  CAST(coalesce(sum(VAL_REVENUES), 0) AS {money}) AS TOTAL_REVENUES,
  CAST(coalesce(sum(VAL_COST), 0) AS {money}) AS TOTAL_COST,
  CAST(coalesce(sum(VAL_MARGIN), 0) AS {money}) AS TOTAL_MARGIN,
  count(ID_ORDER_NUM) AS N_ORDERS
FROM olap WHERE {' AND '.join(k.strip() + ' IS NOT NULL' for k in keys.split(','))}
GROUP BY {keys}"""


MONTH_KEYS = "ORDER_YEAR, ORDER_MONTH, ID_COMPANY, DESC_BUSINESS_LINE, ID_COUNTRY"
CUSTOMER_KEYS = "IDS_CUSTOMER, DESC_CUSTOMER, ID_COUNTRY, DESC_AREA_MANAGER"
ITEM_KEYS = "IDS_ITEM, DESC_ITEM, DESC_BUSINESS_LINE"


OLAP_COLUMNS = ("ID_COMPANY ID_ORDER_NUM IDS_CUSTOMER IDS_ITEM ID_ORDER_DATE ID_INVOICE_DATE VAL_REVENUES "
                "VAL_COST VAL_MARGIN DESC_COMPANY DESC_CUSTOMER ID_COUNTRY ID_AREA_MANAGER DESC_AREA_MANAGER "
                "DESC_ITEM ID_BUSINESS_LINE DESC_BUSINESS_LINE ORDER_YEAR ORDER_MONTH ORDER_WEEK").split()
MONEY = ("VAL_REVENUES", "VAL_COST", "VAL_MARGIN")
CALENDAR = ("ORDER_YEAR", "ORDER_MONTH", "ORDER_WEEK")
DATES = ("ID_ORDER_DATE", "ID_INVOICE_DATE")
CATEGORICAL = tuple(c for c in OLAP_COLUMNS if c not in MONEY + CALENDAR + DATES)


def round_exact(x: str, digits: int = 2, via: int = 6) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,{via})), {digits}) AS DOUBLE)"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _profiles(e: str, ed: str) -> dict[str, str]:
    q: dict[str, str] = {}
    shapes = [("SALES", "sales_src", 8), ("AREA_MANAGER_LOOKUP", "area_src", 2),
              ("COMPANY_LOOKUP", "company_src", 2), ("CUSTOMER_LOOKUP", "customer_src", 4),
              ("ITEM_BUSINESS_LINE_LOOKUP", "bl_src", 2), ("ITEM_LOOKUP", "item_src", 3),
              ("OLAP", "olap", len(OLAP_COLUMNS))]
    q["profile_shape"] = ed + "\n" + _union(
        [f"SELECT '{n}' AS DATASET, count(*) AS ROWS, {k} AS COLUMNS FROM {t}" for n, t, k in shapes])
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in OLAP_COLUMNS)
    pos = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(OLAP_COLUMNS))
    q["profile_missing"] = f"""{ed},
r AS (SELECT count(*) AS _rows, {nulls} FROM olap),
u AS (UNPIVOT r ON {", ".join(OLAP_COLUMNS)} INTO NAME COLUMN_NAME VALUE MISSING)
SELECT COLUMN_NAME, CAST(MISSING AS BIGINT) AS MISSING,
  {round_exact("CAST(MISSING AS DOUBLE) * 100.0::DOUBLE / CAST(_rows AS DOUBLE)", 2, 10)} AS PCT,
  CASE COLUMN_NAME {pos} END AS POSITION
FROM u WHERE MISSING > 0"""
    q["profile_distinct"] = ed + "\n" + _union(
        [f"SELECT '{c}' AS COLUMN_NAME, count(DISTINCT {c}) AS N_DISTINCT FROM olap" for c in OLAP_COLUMNS])
    q["profile_numeric"] = e + "\n" + _union([f"""SELECT '{c}' AS COLUMN_NAME, CAST(count({c}) AS DOUBLE) AS COUNT,
  {round_exact(f"avg({c})")} AS MEAN, {round_exact(f"stddev_samp(CAST({c} AS DOUBLE))")} AS STD,
  {round_exact(f"min({c})")} AS MIN, {round_exact(f"quantile_cont(CAST({c} AS DOUBLE), 0.25)")} AS P25,
  {round_exact(f"quantile_cont(CAST({c} AS DOUBLE), 0.5)")} AS P50,
  {round_exact(f"quantile_cont(CAST({c} AS DOUBLE), 0.75)")} AS P75, {round_exact(f"max({c})")} AS MAX
FROM olap""" for c in MONEY])
    pairs = _union([f"SELECT '{c}' AS COLUMN_NAME, CAST({c} AS VARCHAR) AS VALUE FROM olap" for c in CATEGORICAL])
    def topk(k: int, nulls: bool) -> str:
        base = "(SELECT count(*) FROM olap)" if nulls else "sum(FREQUENCY) OVER (PARTITION BY COLUMN_NAME)"
        return f"""{ed},
p AS ({pairs}),
c AS (SELECT COLUMN_NAME, VALUE, count(*) AS FREQUENCY FROM p {"" if nulls else "WHERE VALUE IS NOT NULL"} GROUP BY COLUMN_NAME, VALUE),
r AS (SELECT *, row_number() OVER (PARTITION BY COLUMN_NAME ORDER BY FREQUENCY DESC, VALUE ASC NULLS LAST) AS RANK,
        {base} AS N FROM c)
SELECT COLUMN_NAME, CAST(RANK AS INTEGER) AS RANK, VALUE, FREQUENCY,
  {round_exact("CAST(FREQUENCY AS DOUBLE) * 100.0::DOUBLE / CAST(N AS DOUBLE)", 2, 10)} AS PCT
FROM r WHERE RANK <= {k}"""
    q["profile_topk"] = topk(5, True)
    q["profile_topk_10"] = topk(10, True)
    q["profile_topk_10_values"] = topk(10, False)
    q["profile_range"] = e + "\n" + _union(
        [f"SELECT '{c}' AS COLUMN_NAME, CAST(min({c}) AS DOUBLE) AS MIN, CAST(max({c}) AS DOUBLE) AS MAX FROM olap"
         for c in MONEY])
    q["profile_dates"] = ed + "\n" + _union(
        [f"SELECT '{c}' AS COLUMN_NAME, min({c}) AS MIN, max({c}) AS MAX FROM olap" for c in DATES])

    def corr_sql(cols, src):
        parts = []
        for a in cols:
            for b in cols:
                xa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
                xb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
                parts.append(f"SELECT '{a}' AS COL_A, '{b}' AS COL_B, round(covar_samp({xa}, {xb}) / "
                             f"nullif(stddev_samp({xa}) * stddev_samp({xb}), 0), 3) AS CORR FROM {src}")
        return _union(parts)
    q["correlation"] = e + "\n" + corr_sql(list(MONEY + CALENDAR), "olap")
    q["correlation_profit"] = (e + ",\nop AS (SELECT *, VAL_REVENUES - VAL_COST AS VAL_PROFIT FROM olap)\n"
                               + corr_sql(["VAL_REVENUES", "VAL_COST", "VAL_PROFIT"], "op"))

    def binexpr(x, lo, hi, bins):
        return (f"CAST(CASE WHEN {hi} = {lo} THEN 0 ELSE least(floor(({x} - {lo}) * {float(bins)} / ({hi} - {lo})), "
                f"{bins - 1}) END AS INTEGER)")
    q["revenue_histogram"] = f"""{e},
b AS (SELECT min(CAST(VAL_REVENUES AS DOUBLE)) AS lo, max(CAST(VAL_REVENUES AS DOUBLE)) AS hi FROM olap),
c AS (SELECT {binexpr("CAST(VAL_REVENUES AS DOUBLE)", "lo", "hi", 50)} AS BIN, count(*) AS COUNT
      FROM olap, b WHERE VAL_REVENUES IS NOT NULL GROUP BY 1)
SELECT CAST(g.range AS INTEGER) AS BIN, lo + CAST(g.range AS INTEGER) * ((hi - lo) / 50.0::DOUBLE) AS LOWER,
  lo + (CAST(g.range AS INTEGER) + 1) * ((hi - lo) / 50.0::DOUBLE) AS UPPER, coalesce(c.COUNT, 0) AS COUNT
FROM range(50) g CROSS JOIN b LEFT JOIN c ON c.BIN = g.range"""
    q["revenue_density"] = f"""{e},
x AS (SELECT CAST(VAL_REVENUES AS DOUBLE) AS x FROM olap WHERE VAL_REVENUES IS NOT NULL),
s AS (SELECT min(x) AS lo, max(x) AS hi, CAST(count(*) AS DOUBLE) AS n, stddev_samp(x) AS sd FROM x),
p AS (SELECT lo, hi, n, sd * pow(n, -0.2) AS h, (hi - lo) / 199.0::DOUBLE AS step FROM s),
d AS (SELECT g.range AS POINT, sum(exp(-0.5 * pow((lo + g.range * step - x) / h, 2))) AS S
      FROM x, p, range(200) g GROUP BY g.range)
SELECT CAST(POINT AS INTEGER) AS POINT, lo + POINT * step AS X,
  round(S / (n * h * 2.5066282746310002) * 1e6, 6) AS DENSITY_PER_MILLION,
  round(S / (n * h * 2.5066282746310002) * n * ((hi - lo) / 50.0::DOUBLE), 3) AS COUNT_DENSITY
FROM d, p"""
    q["revenue_box"] = f"""{e},
d AS (SELECT ID_BUSINESS_LINE, CAST(VAL_REVENUES AS DOUBLE) AS X FROM olap WHERE VAL_REVENUES IS NOT NULL),
q AS (SELECT ID_BUSINESS_LINE, quantile_cont(X, 0.25) AS Q1, quantile_cont(X, 0.5) AS MEDIAN,
        quantile_cont(X, 0.75) AS Q3 FROM d GROUP BY ID_BUSINESS_LINE),
t AS (SELECT d.ID_BUSINESS_LINE, count(*) AS N,
        min(X) FILTER (WHERE X >= Q1 - 1.5 * (Q3 - Q1) AND X <= Q3 + 1.5 * (Q3 - Q1)) AS WHISKER_LOW,
        max(X) FILTER (WHERE X >= Q1 - 1.5 * (Q3 - Q1) AND X <= Q3 + 1.5 * (Q3 - Q1)) AS WHISKER_HIGH,
        count(*) FILTER (WHERE NOT (X >= Q1 - 1.5 * (Q3 - Q1) AND X <= Q3 + 1.5 * (Q3 - Q1))) AS N_OUTLIERS
      FROM d JOIN q USING (ID_BUSINESS_LINE) GROUP BY d.ID_BUSINESS_LINE)
SELECT ID_BUSINESS_LINE, N, {round_exact("Q1")} AS Q1, {round_exact("MEDIAN")} AS MEDIAN, {round_exact("Q3")} AS Q3,
  {round_exact("Q3 - Q1")} AS IQR, {round_exact("WHISKER_LOW")} AS WHISKER_LOW,
  {round_exact("WHISKER_HIGH")} AS WHISKER_HIGH, N_OUTLIERS
FROM q JOIN t USING (ID_BUSINESS_LINE)"""
    q["cost_revenue_bins"] = f"""{e},
b AS (SELECT min(CAST(VAL_COST AS DOUBLE)) AS xlo, max(CAST(VAL_COST AS DOUBLE)) AS xhi,
             min(CAST(VAL_REVENUES AS DOUBLE)) AS ylo, max(CAST(VAL_REVENUES AS DOUBLE)) AS yhi FROM olap)
SELECT {binexpr("CAST(VAL_COST AS DOUBLE)", "xlo", "xhi", 50)} AS BIN_X,
  {binexpr("CAST(VAL_REVENUES AS DOUBLE)", "ylo", "yhi", 50)} AS BIN_Y, count(*) AS COUNT
FROM olap, b WHERE VAL_COST IS NOT NULL AND VAL_REVENUES IS NOT NULL GROUP BY 1, 2"""
    return q


FEATURES = ("MONTH_IDX", "ORDER_MONTH", "LAG_1")


def _det3(a):
    return (f"(({a[0][0]} * (({a[1][1]} * {a[2][2]}) - ({a[1][2]} * {a[2][1]}))) "
            f"- ({a[0][1]} * (({a[1][0]} * {a[2][2]}) - ({a[1][2]} * {a[2][0]})))) "
            f"+ ({a[0][2]} * (({a[1][0]} * {a[2][1]}) - ({a[1][1]} * {a[2][0]})))")


def _forecast_ctes(e: str, series: list[str], splits: int = 3) -> str:
    """monthly totals (t), features (f), folds (fo), coefficients (co), last month (lm)."""
    sk = ", ".join(series)
    sk_ = sk + ", " if series else ""
    part = f"PARTITION BY {sk} " if series else ""
    on = " AND ".join(f"a.{k} = b.{k}" for k in series) if series else "TRUE"
    xs = [f"CAST({c} AS DOUBLE)" for c in FEATURES]
    y = "CAST(TOTAL_REVENUES AS DOUBLE)"

    def c(i, j):
        i, j = min(i, j), max(i, j)
        return f"_c{i}{j}"
    a = [[c(i, j) for j in range(3)] for i in range(3)]
    rhs = [f"_c{i}y" for i in range(3)]
    det = _det3(a)
    varies = [f"(_c{i}{i} > 1e-24 * _m{i} * _m{i})" for i in range(3)]
    unit = [[f"(CASE WHEN {varies[i]} THEN 1.0::DOUBLE ELSE 0.0 END)" if i == j else
             f"(CASE WHEN {varies[i]} AND {varies[j]} THEN {c(i, j)} / sqrt(_c{i}{i} * _c{j}{j}) ELSE 0.0 END)"
             for j in range(3)] for i in range(3)]
    pairs = [(0, 1), (0, 2), (1, 2)]
    minors = " + ".join(f"({unit[i][i]} * {unit[j][j]} - {unit[i][j]} * {unit[i][j]})" for i, j in pairs)
    e2 = " + ".join(f"({a[i][i]} * {a[j][j]} - {a[i][j]} * {a[i][j]})" for i, j in pairs)
    rank = (f"CASE WHEN {_det3(unit)} > 1e-10 THEN 3 WHEN {minors} > 1e-10 THEN 2 "
            f"WHEN {' OR '.join(varies)} THEN 1 ELSE 0 END")
    betas = []
    for k in range(3):
        ak = [[rhs[i] if j == k else a[i][j] for j in range(3)] for i in range(3)]
        two = " + ".join(f"({a[j][j]} * {rhs[k]} - {a[k][j]} * {rhs[j]})" for j in range(3) if j != k)
        betas.append(f"CASE RANK WHEN 3 THEN ({_det3(ak)}) / ({det}) WHEN 2 THEN ({two}) / ({e2}) "
                     f"WHEN 1 THEN {rhs[k]} / (_c00 + _c11 + _c22) ELSE 0.0 END AS B_{FEATURES[k]}")
    covs = ", ".join([f"coalesce(covar_samp({xs[i]}, {xs[j]}), 0.0) AS _c{i}{j}" for i in range(3) for j in range(i, 3)]
                     + [f"coalesce(covar_samp({xs[i]}, {y}), 0.0) AS _c{i}y" for i in range(3)])
    return f"""{e},
m AS ({_totals(MONTH_KEYS, "DECIMAL(38,4)")}),
t AS (SELECT {sk_}ORDER_YEAR, ORDER_MONTH, CAST(sum(TOTAL_REVENUES) AS DOUBLE) AS TOTAL_REVENUES,
        CAST(sum(N_ORDERS) AS BIGINT) AS N_ORDERS FROM m GROUP BY {sk_}ORDER_YEAR, ORDER_MONTH),
s AS (SELECT *, CAST(row_number() OVER ({part}ORDER BY ORDER_YEAR, ORDER_MONTH) - 1 AS INTEGER) AS MONTH_IDX,
        lag(TOTAL_REVENUES) OVER ({part}ORDER BY ORDER_YEAR, ORDER_MONTH) AS LAG_1 FROM t),
f AS (SELECT *, MONTH_IDX - 1 AS SAMPLE FROM s WHERE LAG_1 IS NOT NULL),
fn AS (SELECT *, count(*) OVER ({part}) AS _n FROM f),
fn2 AS (SELECT *, CAST(floor(_n / {splits + 1}) AS BIGINT) AS _ts FROM fn),
fo AS (SELECT * EXCLUDE (_n, _ts) FROM (
  SELECT fn2.*, CAST(k.range AS INTEGER) AS FOLD,
    CASE WHEN k.range = 0 THEN 'TRAIN' WHEN _ts < 1 THEN NULL
         WHEN SAMPLE < _n - ({splits} - k.range + 1) * _ts THEN 'TRAIN'
         WHEN SAMPLE < _n - ({splits} - k.range + 1) * _ts + _ts THEN 'TEST' END AS ROLE
  FROM fn2, range({splits + 1}) k) WHERE ROLE IS NOT NULL),
mo AS (SELECT {sk_}FOLD, count(*) AS N_TRAIN, avg({y}) AS _my, {", ".join(f"avg({x}) AS _m{i}" for i, x in enumerate(xs))},
         {covs}
       FROM fo WHERE ROLE = 'TRAIN' GROUP BY {sk_}FOLD),
mo2 AS (SELECT *, {rank} AS RANK FROM mo),
co0 AS (SELECT {sk_}FOLD, N_TRAIN, RANK, {", ".join(betas)}, RANK < 3 AS SINGULAR, _my, _m0, _m1, _m2 FROM mo2),
co AS (SELECT * EXCLUDE (_my, _m0, _m1, _m2),
         _my - (((B_MONTH_IDX * _m0) + (B_ORDER_MONTH * _m1)) + (B_LAG_1 * _m2)) AS INTERCEPT FROM co0),
pr AS (SELECT fo.*, (((B_MONTH_IDX * CAST(MONTH_IDX AS DOUBLE)) + (B_ORDER_MONTH * CAST(ORDER_MONTH AS DOUBLE)))
         + (B_LAG_1 * CAST(LAG_1 AS DOUBLE))) + INTERCEPT AS PREDICTION
       FROM fo JOIN co USING ({sk_}FOLD)),
lm AS (SELECT {sk_}arg_max(MONTH_IDX, MONTH_IDX) AS LAST_IDX, arg_max(ORDER_YEAR, MONTH_IDX) AS LAST_YEAR,
         arg_max(ORDER_MONTH, MONTH_IDX) AS LAST_MONTH, arg_max(TOTAL_REVENUES, MONTH_IDX) AS LAST_REVENUE
       FROM s {"GROUP BY " + sk if series else ""})"""


def _recursive(ctes: str) -> str:
    return ctes.replace("WITH ", "WITH RECURSIVE ", 1)


def _rollout(horizon: int, series: list[str]) -> str:
    sk_ = ", ".join(series) + ", " if series else ""
    sel = ", ".join(f"r.{k}" for k in series) + ", " if series else ""
    using = f"USING ({', '.join(series)})" if series else "ON TRUE"
    raw = ("(((B_MONTH_IDX * CAST(LAST_IDX + r.k + 1 AS DOUBLE)) + (B_ORDER_MONTH * "
           "CAST((LAST_MONTH + r.k + 1 - 1) % 12 + 1 AS DOUBLE))) + (B_LAG_1 * r.lag)) + INTERCEPT")
    pred = f"CASE WHEN ({raw}) IS NOT NULL THEN greatest({raw}, 0.0) END"
    return f""",
base AS (SELECT lm.*, co.B_MONTH_IDX, co.B_ORDER_MONTH, co.B_LAG_1, co.INTERCEPT
         FROM lm JOIN (SELECT * FROM co WHERE FOLD = 0) co {using}),
roll AS (
  SELECT {sk_}0 AS k, CAST(LAST_REVENUE AS DOUBLE) AS lag, NULL::DOUBLE AS p, LAST_IDX, LAST_MONTH, LAST_YEAR,
         B_MONTH_IDX, B_ORDER_MONTH, B_LAG_1, INTERCEPT FROM base
  UNION ALL
  SELECT {sel}r.k + 1, {pred}, {pred}, r.LAST_IDX, r.LAST_MONTH, r.LAST_YEAR,
         r.B_MONTH_IDX, r.B_ORDER_MONTH, r.B_LAG_1, r.INTERCEPT
  FROM roll r WHERE r.k < {horizon})
SELECT {sk_}CAST(LAST_YEAR + floor((LAST_MONTH + k - 1) / 12) AS INTEGER) AS ORDER_YEAR,
  CAST((LAST_MONTH + k - 1) % 12 + 1 AS INTEGER) AS ORDER_MONTH,
  make_date(CAST(LAST_YEAR + floor((LAST_MONTH + k - 1) / 12) AS INTEGER), CAST((LAST_MONTH + k - 1) % 12 + 1 AS INTEGER), 1) AS DATE,
  round(p, 2) AS FORECAST_REVENUES, 'PREVISIONE' AS TIPO
FROM roll WHERE k >= 1"""


_METRICS = """,
per AS (SELECT FOLD, count(*) AS N_TEST, avg(abs(CAST(TOTAL_REVENUES AS DOUBLE) - PREDICTION)) AS MAE,
          sqrt(avg((CAST(TOTAL_REVENUES AS DOUBLE) - PREDICTION) * (CAST(TOTAL_REVENUES AS DOUBLE) - PREDICTION))) AS RMSE,
          sum((CAST(TOTAL_REVENUES AS DOUBLE) - PREDICTION) * (CAST(TOTAL_REVENUES AS DOUBLE) - PREDICTION)) AS sse,
          count(*) * var_pop(CAST(TOTAL_REVENUES AS DOUBLE)) AS sst
        FROM pr WHERE ROLE = 'TEST' AND FOLD > 0 GROUP BY FOLD),
per2 AS (SELECT FOLD, N_TEST, MAE, RMSE,
           CASE WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 - sse / sst END AS R2 FROM per),
allr AS (SELECT * FROM per2 UNION ALL
         SELECT 0, NULL, avg(MAE), avg(RMSE), avg(R2) FROM per2)
SELECT 'LINEAR' AS MODEL, CAST(FOLD AS INTEGER) AS FOLD, N_TEST, round(MAE, {}) AS MAE, round(RMSE, {}) AS RMSE,
  round(R2, {}) AS R2 FROM allr"""


def _forecasts(e: str) -> dict[str, str]:
    q: dict[str, str] = {}
    fc = _forecast_ctes(e, [])
    q["forecast_features"] = fc + "\nSELECT ORDER_YEAR, ORDER_MONTH, TOTAL_REVENUES, N_ORDERS, MONTH_IDX, LAG_1, SAMPLE FROM f"
    q["cv_folds"] = fc + ("\nSELECT FOLD, ROLE, SAMPLE, ORDER_YEAR, ORDER_MONTH, MONTH_IDX, LAG_1, TOTAL_REVENUES "
                          "FROM fo")
    model = ("\nSELECT FOLD, N_TRAIN, RANK, SINGULAR, round(B_MONTH_IDX, {}) AS B_MONTH_IDX, "
             "round(B_ORDER_MONTH, {}) AS B_ORDER_MONTH, round(B_LAG_1, {}) AS B_LAG_1, "
             "round(INTERCEPT, {}) AS INTERCEPT FROM co")
    short = _forecast_ctes(e, [], 12)
    q["linear_model"] = fc + model.format(4, 4, 10, 2)
    q["linear_model_short_folds"] = short + model.format(2, 2, 8, 0)
    q["cv_metrics"] = fc + _METRICS.format(0, 0, 4)
    q["cv_metrics_short_folds"] = short + _METRICS.format(0, 0, 4)
    q["forecast_linear"] = _recursive(fc) + _rollout(6, [])
    fcs = _forecast_ctes(e, ["ID_COMPANY"])
    q["forecast_linear_by_company"] = _recursive(fcs) + _rollout(6, ["ID_COMPANY"])
    six = _recursive(fc) + _rollout(6, [])
    twelve = _recursive(fc) + _rollout(12, [])
    q["compare_horizons"] = (f"SELECT *, 6 AS HORIZON FROM ({six})\nUNION ALL\n"
                             f"SELECT *, 12 AS HORIZON FROM ({twelve})")
    q["history_plus_forecast"] = (f"{_recursive(fc)}\nSELECT ORDER_YEAR, ORDER_MONTH, TOTAL_REVENUES AS FORECAST_REVENUES, "
                                  f"make_date(ORDER_YEAR, ORDER_MONTH, 1) AS DATE, 'STORICO' AS TIPO FROM t\n"
                                  f"UNION ALL BY NAME\nSELECT * FROM ({six})")
    return q


def _boosted(fc: str, series: list[str], trees: int = 100) -> str:
    """Boosted trees of depth 2 as a recursion over trees: b holds every fold row with its prediction so far, the gains
    of each feature so far and, on one row of each model, the trees; h has the state after the last tree."""
    keys = [*series, "FOLD"]
    k_, on = ", ".join(keys), " AND ".join(f"a.{k} IS NOT DISTINCT FROM c.{k}" for k in keys)
    draw = "((SAMPLE * 1103515245 + (t * 12345 + 42) * 69069) % 2147483647)"
    for _ in range(3):
        draw = f"(({draw} * 48271 + 11) % 2147483647)"

    def level(name: str, rows: str) -> str:
        """Best cut of each (keys, node) of the drawn rows: j, edge, gain, low, high (one row each, j null without a cut)."""
        return f"""
{name}_v AS (SELECT {k_}, node, unnest([struct_pack(j := 0, x := x0), struct_pack(j := 1, x := x1), struct_pack(j := 2, x := x2)]) AS v, r
             FROM {rows} WHERE drawn),
{name}_c AS (SELECT {k_}, node, v.j AS j, v.x AS x, sum(r) AS s, sum(r * r) AS q, count(*) AS n FROM {name}_v GROUP BY ALL),
{name}_w AS (SELECT {k_}, node, j, x, sum(s) OVER run AS sl, CAST(sum(n) OVER run AS DOUBLE) AS nl, sum(s) OVER every AS s,
               CAST(sum(n) OVER every AS DOUBLE) AS n, sum(q) OVER every AS q, lead(x) OVER run AS next FROM {name}_c
             WINDOW every AS (PARTITION BY {k_}, node, j), run AS (PARTITION BY {k_}, node, j ORDER BY x)),
{name}_g AS (SELECT *, sl / nl AS low, (s - sl) / (n - nl) AS high, nl * (n - nl) / n * (sl / nl - (s - sl) / (n - nl)) * (sl / nl - (s - sl) / (n - nl)) AS gain
             FROM {name}_w WHERE next IS NOT NULL AND q > 0),
{name}_b AS (SELECT {k_}, node, arg_min(struct_pack(j := j, edge := (x + next) / 2, gain := gain, low := low, high := high),
                                        struct_pack(a := -round(gain / q, 10), b := j, c := x)) AS cut
             FROM {name}_g WHERE round(gain / q, 10) > 0 GROUP BY {k_}, node),
{name} AS (SELECT a.*, c.cut FROM (SELECT {k_}, node, sum(r) / count(*) AS mean, count(*) AS m FROM {rows} WHERE drawn GROUP BY {k_}, node) a
           LEFT JOIN {name}_b c ON {on} AND a.node = c.node)"""

    def right(alias: str) -> str:
        return f"coalesce(CASE {alias}.cut.j WHEN 0 THEN a.x0 WHEN 1 THEN a.x1 ELSE a.x2 END > {alias}.cut.edge, FALSE)"
    gains = ", ".join(f"g{j} + coalesce(CASE WHEN root.j = {j} THEN root.gain ELSE 0 END / m, 0) + coalesce(CASE WHEN gl.j = {j} THEN gl.gain ELSE 0 END / m, 0)"
                      f" + coalesce(CASE WHEN gr.j = {j} THEN gr.gain ELSE 0 END / m, 0) AS g{j}" for j in range(3))
    return f"""{_recursive(fc)},
b AS (
  SELECT a.{", a.".join(keys)}, CAST(a.SAMPLE AS BIGINT) AS SAMPLE, a.ROLE, CAST(a.MONTH_IDX AS DOUBLE) AS x0, CAST(a.ORDER_MONTH AS DOUBLE) AS x1, CAST(a.LAG_1 AS DOUBLE) AS x2,
         CAST(a.TOTAL_REVENUES AS DOUBLE) AS y, base AS f, base, CAST(0 AS BIGINT) AS t, CAST(0 AS DOUBLE) AS g0, CAST(0 AS DOUBLE) AS g1, CAST(0 AS DOUBLE) AS g2,
         CAST([] AS STRUCT(j INTEGER, edge DOUBLE, lj INTEGER, le DOUBLE, rj INTEGER, re DOUBLE, v0 DOUBLE, v1 DOUBLE, v2 DOUBLE, v3 DOUBLE)[]) AS trees
  FROM fo a JOIN (SELECT {k_}, avg(CAST(TOTAL_REVENUES AS DOUBLE)) AS base FROM fo WHERE ROLE = 'TRAIN' GROUP BY {k_}) c ON {on}
  UNION ALL (
  WITH s AS (SELECT *, y - f AS r, ROLE = 'TRAIN' AND {draw} < 1717986917 AS drawn, 0 AS node FROM b WHERE t < {trees}),{level("l1", "s")},
  s2 AS (SELECT a.* EXCLUDE (node), CAST({right("c")} AS INTEGER) AS node, c.cut AS root, c.mean AS mean, c.m AS m
         FROM s a LEFT JOIN l1 c ON {on}),{level("l2", "s2")},
  s3 AS (SELECT a.* EXCLUDE (node), a.node, c.cut AS cut, gl.cut AS gl, gr.cut AS gr, gl.mean AS ml, gr.mean AS mr
         FROM s2 a LEFT JOIN l2 c ON {on} AND a.node = c.node
         LEFT JOIN (SELECT * FROM l2 WHERE node = 0) gl ON {on.replace("c.", "gl.")} LEFT JOIN (SELECT * FROM l2 WHERE node = 1) gr ON {on.replace("c.", "gr.")}),
  s4 AS (SELECT *, coalesce(gl.low, ml, 0) AS v0, coalesce(gl.high, ml, 0) AS v1, coalesce(gr.low, mr, ml, 0) AS v2, coalesce(gr.high, mr, ml, 0) AS v3 FROM s3)
  SELECT {k_}, SAMPLE, ROLE, x0, x1, x2, y,
         f + 0.1::DOUBLE * CASE WHEN node = 0 THEN CASE WHEN {right("a").replace("a.cut", "a.gl")} THEN v1 ELSE v0 END
                                ELSE CASE WHEN {right("a").replace("a.cut", "a.gr")} THEN v3 ELSE v2 END END AS f,
         base, t + 1 AS t, {gains},
         CASE WHEN SAMPLE = 0 THEN list_append(trees, struct_pack(j := root.j, edge := root.edge, lj := gl.j, le := gl.edge, rj := gr.j, re := gr.edge,
                                                                  v0 := v0, v1 := v1, v2 := v2, v3 := v3)) ELSE trees END AS trees
  FROM s4 a)),
h AS (SELECT * FROM b WHERE t = {trees})"""


def _gbt(e: str) -> dict[str, str]:
    q: dict[str, str] = {}
    for suffix, series in (("", []), ("_by_company", ["ID_COMPANY"])):
        sk_ = "".join(f"{k}, " for k in series)
        fc = _forecast_ctes(e, series)
        grown = _boosted(fc, series)
        y, p = "y", "f"
        group = f"GROUP BY {', '.join(series)}" if series else ""
        q["gbt_model" if not series else "gbt_by_company"] = grown + f""",
per AS (SELECT {sk_}FOLD, count(*) AS N_TEST, avg(abs({y} - {p})) AS MAE, sqrt(avg(({y} - {p}) * ({y} - {p}))) AS RMSE,
          sum(({y} - {p}) * ({y} - {p})) AS sse, count(*) * var_pop({y}) AS sst FROM h WHERE ROLE = 'TEST' AND FOLD > 0 GROUP BY {sk_}FOLD),
per2 AS (SELECT {sk_}FOLD, N_TEST, MAE, RMSE, CASE WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 - sse / sst END AS R2 FROM per)
SELECT 'GBT' AS MODEL, {sk_}CAST(FOLD AS INTEGER) AS FOLD, N_TEST, round(MAE, 0) AS MAE, round(RMSE, 0) AS RMSE, round(R2, 4) AS R2
FROM (SELECT * FROM per2 UNION ALL SELECT {sk_}0, NULL, avg(MAE), avg(RMSE), avg(R2) FROM per2 {group or "HAVING count(*) > 0"})"""
        q["gbt_importance" + suffix] = grown + f"""
SELECT {sk_}v.name AS FEATURE, round(CASE WHEN g0 + g1 + g2 > 0 THEN v.g / (g0 + g1 + g2) ELSE 0 END, 6) AS IMPORTANCE
FROM (SELECT *, unnest([struct_pack(name := 'MONTH_IDX', g := g0), struct_pack(name := 'ORDER_MONTH', g := g1), struct_pack(name := 'LAG_1', g := g2)]) AS v
      FROM h WHERE FOLD = 0 AND SAMPLE = 0)"""
        x = [f"CAST({c} AS DOUBLE)" for c in ("r.LAST_IDX + r.k + 1", "(r.LAST_MONTH + r.k + 1 - 1) % 12 + 1", "r.lag")]

        def side(j: str, edge: str) -> str:
            return f"coalesce(CASE w.{j} WHEN 0 THEN {x[0]} WHEN 1 THEN {x[1]} WHEN 2 THEN {x[2]} END > w.{edge}, FALSE)"
        leaf = (f"CASE WHEN {side('j', 'edge')} THEN CASE WHEN {side('rj', 're')} THEN w.v3 ELSE w.v2 END "
                f"ELSE CASE WHEN {side('lj', 'le')} THEN w.v1 ELSE w.v0 END END")
        using = " AND ".join(f"lm.{k} IS NOT DISTINCT FROM m.{k}" for k in series) or "TRUE"
        roll = grown + f""",
roll AS (
  SELECT {"".join(f"lm.{k}, " for k in series)}0 AS k, CAST(LAST_REVENUE AS DOUBLE) AS lag, LAST_IDX, LAST_MONTH, LAST_YEAR, m.base, m.trees
  FROM lm JOIN (SELECT * FROM h WHERE FOLD = 0 AND SAMPLE = 0) m ON {using}
  UNION ALL
  SELECT {"".join(f"r.{k}, " for k in series)}r.k + 1,
         greatest(list_reduce(list_prepend(r.base, list_transform(r.trees, lambda w: 0.1::DOUBLE * {leaf})), lambda a, v: a + v), 0.0),
         r.LAST_IDX, r.LAST_MONTH, r.LAST_YEAR, r.base, r.trees
  FROM roll r WHERE r.k < 6)
SELECT {sk_}CAST(LAST_YEAR + floor((LAST_MONTH + k - 1) / 12) AS INTEGER) AS ORDER_YEAR, CAST((LAST_MONTH + k - 1) % 12 + 1 AS INTEGER) AS ORDER_MONTH,
  make_date(CAST(LAST_YEAR + floor((LAST_MONTH + k - 1) / 12) AS INTEGER), CAST((LAST_MONTH + k - 1) % 12 + 1 AS INTEGER), 1) AS DATE,
  round(lag, 2) AS FORECAST_REVENUES, 'PREVISIONE' AS TIPO
FROM roll WHERE k >= 1"""
        q["forecast_gbt" + suffix] = roll
        linear = _recursive(fc) + _rollout(6, series)
        cols = f"{sk_}ORDER_YEAR, ORDER_MONTH, DATE, FORECAST_REVENUES AS REVENUES"
        q["compare_models" + suffix] = f"""SELECT 'LINEAR' AS MODEL, {cols} FROM ({linear})
UNION ALL BY NAME SELECT 'GBT' AS MODEL, {cols} FROM ({roll})
UNION ALL BY NAME ({fc} SELECT 'STORICO' AS MODEL, {sk_}ORDER_YEAR, ORDER_MONTH, make_date(ORDER_YEAR, ORDER_MONTH, 1) AS DATE, TOTAL_REVENUES AS REVENUES FROM t)"""
    return q


TABLES = {  # name -> (source CTE, columns, kinds for the null policy)
    "SALES": ("sales_src", ["ID_COMPANY", "ID_ORDER_NUM", "IDS_CUSTOMER", "IDS_ITEM", "ID_ORDER_DATE",
                            "ID_INVOICE_DATE", "VAL_REVENUES", "VAL_COST"]),
    "AREA_MANAGER_LOOKUP": ("area_src", ["ID_AREA_MANAGER", "DESC_AREA_MANAGER"]),
    "COMPANY_LOOKUP": ("company_src", ["ID_COMPANY", "DESC_COMPANY"]),
    "CUSTOMER_LOOKUP": ("customer_src", ["IDS_CUSTOMER", "DESC_CUSTOMER", "ID_COUNTRY", "ID_AREA_MANAGER"]),
    "ITEM_BUSINESS_LINE_LOOKUP": ("bl_src", ["ID_BUSINESS_LINE", "DESC_BUSINESS_LINE"]),
    "ITEM_LOOKUP": ("item_src", ["IDS_ITEM", "DESC_ITEM", "ID_BUSINESS_LINE"]),
}
PKS = {"CUSTOMER_LOOKUP": "IDS_CUSTOMER", "ITEM_LOOKUP": "IDS_ITEM", "AREA_MANAGER_LOOKUP": "ID_AREA_MANAGER",
       "ITEM_BUSINESS_LINE_LOOKUP": "ID_BUSINESS_LINE", "COMPANY_LOOKUP": "ID_COMPANY"}
# (child, fk, parent, child state CTE, parent state CTE) in check order
FK_SEEN = [("SALES", "ID_COMPANY", "COMPANY_LOOKUP", "sales_d", "company_pk"),
           ("SALES", "IDS_CUSTOMER", "CUSTOMER_LOOKUP", "sales_fk1", "customer_pk"),
           ("SALES", "IDS_ITEM", "ITEM_LOOKUP", "sales_fk2", "item_pk"),
           ("CUSTOMER_LOOKUP", "ID_AREA_MANAGER", "AREA_MANAGER_LOOKUP", "customer_pk", "area_pk"),
           ("ITEM_LOOKUP", "ID_BUSINESS_LINE", "ITEM_BUSINESS_LINE_LOOKUP", "item_pk", "bl_pk")]
FK_STATE = {"SALES": "sales_fk", "CUSTOMER_LOOKUP": "customer_fk", "ITEM_LOOKUP": "item_fk",
            "AREA_MANAGER_LOOKUP": "area_pk", "COMPANY_LOOKUP": "company_pk", "ITEM_BUSINESS_LINE_LOOKUP": "bl_pk"}
TECHNICAL = {"SALES": ["ID_ORDER_NUM", "ID_ORDER_DATE", "ID_INVOICE_DATE"], "CUSTOMER_LOOKUP": ["ID_COUNTRY"]}


def _policy(table: str, src: str, cols: list[str], kinds: dict[str, str]) -> str:
    """Sequential null counts: each column counted over rows whose earlier
    DATE/CRITICAL columns are present."""
    exprs, alive, rows = [], "TRUE", []
    for i, c in enumerate(cols):
        exprs.append(f"count(*) FILTER (WHERE {alive} AND {c} IS NULL) AS n{i}")
        if kinds[c] in ("DATE", "CRITICAL"):
            alive += f" AND {c} IS NOT NULL"
    for i, c in enumerate(cols):
        k = kinds[c]
        act = "DROP" if k in ("DATE", "CRITICAL") else "KEEP"
        lvl = "ERROR" if k in ("DATE", "CRITICAL", "DERIVED") else "WARNING"
        rows.append(f"SELECT '{table}' AS TABLE_NAME, '{c}' AS COLUMN_NAME, '{k}' AS KIND, CAST(n{i} AS BIGINT) AS NULLS, "
                    f"'{act}' AS ACTION, '{lvl}' AS LEVEL, {i} AS POSITION FROM agg_{table} WHERE n{i} > 0")
    return f"agg_{table} AS (SELECT {', '.join(exprs)} FROM {src})", _union(rows)


def _kinds(cols: list[str], types: dict[str, str], derived=()) -> dict[str, str]:
    out = {}
    for c in cols:
        if c in derived:
            out[c] = "DERIVED"
        elif "DATE" in c.upper():
            out[c] = "DATE"
        elif c in ("VAL_REVENUES", "VAL_COST"):
            out[c] = "CRITICAL"
        else:
            out[c] = types.get(c, "TEXT")
    return out


def _cleaning(ed: str) -> dict[str, str]:
    q: dict[str, str] = {}
    q["dedup_rows"] = ed + "\n" + _union([
        f"SELECT '{n}' AS TABLE_NAME, (SELECT count(*) FROM {src}) AS ROWS_BEFORE, "
        f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS ROWS_AFTER, "
        f"(SELECT count(*) FROM {src}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS REMOVED"
        for n, (src, _) in TABLES.items()])
    q["pk_repair"] = ed + "\nSELECT * FROM item_pk"
    q["load_csv"] = ed + ("\nSELECT * REPLACE (CAST(VAL_REVENUES AS DOUBLE) AS VAL_REVENUES, "
                          "CAST(VAL_COST AS DOUBLE) AS VAL_COST) FROM sales_src")
    q["fk_repair"] = ed + "\nSELECT * REPLACE (CAST(VAL_REVENUES AS DOUBLE) AS VAL_REVENUES, CAST(VAL_COST AS DOUBLE) AS VAL_COST) FROM sales_fk"
    q["fk_orphans"] = ed + "\n" + _union([
        f"SELECT '{c}' AS CHILD, '{fk}' AS FK, '{p}' AS PARENT, {fk} AS VALUE, count(*) AS ROWS FROM {cs} "
        f"WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {PKS[p]} FROM {ps} WHERE {PKS[p]} IS NOT NULL) GROUP BY {fk}"
        for c, fk, p, cs, ps in FK_SEEN])
    q["technical_keys"] = ed + "\n" + _union([
        f"SELECT '{t}' AS TABLE_NAME, '{k}' AS COLUMN_NAME, count(*) FILTER (WHERE {k} IS NULL) AS NULLS FROM {FK_STATE[t]}"
        for t, ks in TECHNICAL.items() for k in ks])

    def audit_rows(phase, table, column, src, checks):
        return [f"SELECT '{phase}' AS PHASE, {table} AS TABLE_NAME, {column} AS COLUMN_NAME, '{ck}' AS \"CHECK\", "
                + (f"'INFO'" if lvl == "INFO" else f"CASE WHEN ({expr}) > 0 THEN '{lvl}' ELSE 'OK' END")
                + f" AS LEVEL, CAST(({expr}) AS BIGINT) AS N FROM {src}" for ck, lvl, expr in checks]
    parts = []
    for n, (src, _) in TABLES.items():
        parts += audit_rows("DEDUP", f"'{n}'", "NULL", f"(SELECT (SELECT count(*) FROM {src}) AS b, "
                            f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS a)",
                            [("ROWS_BEFORE", "INFO", "b"), ("REMOVED", "INFO", "b - a")])
    for n, pk in PKS.items():
        src = TABLES[n][0]
        parts += audit_rows("PK", f"'{n}'", f"'{pk}'", f"(SELECT count(*) FILTER (WHERE {pk} IS NULL) AS nk, "
                            f"count({pk}) - count(DISTINCT {pk}) AS dk FROM (SELECT DISTINCT * FROM {src}))",
                            [("NULL_KEYS", "ERROR", "nk"), ("DUPLICATE_ROWS", "ERROR", "dk")])
    for c, fk, p, cs, ps in FK_SEEN:
        orphan = f"{fk} IS NOT NULL AND {fk} NOT IN (SELECT {PKS[p]} FROM {ps} WHERE {PKS[p]} IS NOT NULL)"
        parts += audit_rows("FK", f"'{c}'", f"'{fk}'", f"(SELECT count(*) FILTER (WHERE {fk} IS NULL) AS nf, "
                            f"count(DISTINCT {fk}) FILTER (WHERE {orphan}) AS ov, "
                            f"count(*) FILTER (WHERE {orphan}) AS orow FROM {cs})",
                            [("NULL_FK", "ERROR", "nf"), ("ORPHAN_VALUES", "ERROR", "ov"), ("ORPHAN_ROWS", "ERROR", "orow")])
    for t, ks in TECHNICAL.items():
        for k in ks:
            parts += audit_rows("TECHNICAL", f"'{t}'", f"'{k}'", f"(SELECT count(*) FILTER (WHERE {k} IS NULL) AS nn FROM {FK_STATE[t]})",
                                [("NULLS", "WARNING", "nn")])
    q["integrity_audit"] = ed + "\n" + _union(parts)

    ctes, sels = [], []
    for n, (src, cols) in TABLES.items():
        state = FK_STATE[n]
        if n == "SALES":
            state = "sales_dt"
        cte, sel = _policy(n, state, cols, _kinds(cols, {}))
        ctes.append(cte)
        sels.append(sel)
    q["nulls_pre"] = ed + ",\n" + ",\n".join(ctes) + "\n" + _union(sels)
    joined = [c for c in OLAP_COLUMNS if c not in CALENDAR]
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in joined)
    pos = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(joined))
    q["null_report"] = f"""{ed},
r AS (SELECT {nulls} FROM olap),
u AS (UNPIVOT r ON {", ".join(joined)} INTO NAME COLUMN_NAME VALUE NULLS)
SELECT COLUMN_NAME, CAST(NULLS AS BIGINT) AS NULLS, CASE COLUMN_NAME {pos} END AS POSITION FROM u WHERE NULLS > 0"""
    cte, sel = _policy("OLAP", "olap", joined, _kinds(joined, {}, derived=("VAL_MARGIN",)))
    q["nulls_post"] = ed + ",\n" + cte + "\n" + sel

    def dprof(c):
        t = f"trim(CAST({c} AS VARCHAR))"
        eight = f"regexp_full_match({t}, '\\d{{8}}')"
        far = f"({eight} AND TRY_CAST(substr({t}, 1, 4) AS INTEGER) > 2262)"
        return (f"SELECT 'SALES' AS TABLE_NAME, '{c}' AS COLUMN_NAME, count(*) FILTER (WHERE {eight}) AS N_8_DIGITS, "
                f"count(*) - count(*) FILTER (WHERE {eight}) AS N_OTHER, count(*) FILTER (WHERE {far}) AS N_YEAR_GT_2262, "
                f"(SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {t} AS v FROM sales_fk WHERE {far} "
                f"ORDER BY v LIMIT 5)) AS EXAMPLES FROM sales_fk")
    q["date_profile"] = ed + "\n" + _union([dprof(c) for c in DATES])
    q["normalise_dates"] = (ed + f"\nSELECT ID_ORDER_NUM, IDS_ITEM, {parse_date('ID_ORDER_DATE')} AS ID_ORDER_DATE, "
                            f"{parse_date('ID_INVOICE_DATE')} AS ID_INVOICE_DATE FROM sales_d")
    q["margin"] = ed + ("\nSELECT ID_ORDER_NUM, IDS_ITEM, CAST(VAL_REVENUES AS DOUBLE) AS VAL_REVENUES, "
                        "CAST(VAL_COST AS DOUBLE) AS VAL_COST, CAST(VAL_REVENUES - VAL_COST AS DOUBLE) AS VAL_MARGIN FROM sales_d")
    od = parse_date("ID_ORDER_DATE")
    q["order_calendar"] = ed + (f"\nSELECT ID_ORDER_NUM, IDS_ITEM, {od} AS ID_ORDER_DATE, CAST(year({od}) AS INTEGER) AS ORDER_YEAR, "
                                f"CAST(month({od}) AS INTEGER) AS ORDER_MONTH, CAST(weekofyear({od}) AS INTEGER) AS ORDER_WEEK "
                                f"FROM sales_d")
    fan = []
    for c, fk, p, _, _ in FK_SEEN:
        cs, ps = TABLES[c][0], TABLES[p][0]
        fan.append(f"SELECT '{c}' AS CHILD, '{fk}' AS FK, '{p}' AS PARENT, (SELECT count(*) FROM (SELECT DISTINCT * FROM {cs})) "
                   f"AS ROWS_BEFORE, (SELECT count(*) FROM (SELECT DISTINCT * FROM {cs}) a LEFT JOIN "
                   f"(SELECT DISTINCT * FROM {ps}) b ON a.{fk} = b.{PKS[p]}) AS ROWS_AFTER")
    q["join_fanout"] = ed + "\n" + _union(fan)
    columns = 'PHASE, TABLE_NAME, COLUMN_NAME, "CHECK", LEVEL, N'
    load = [f"SELECT 'LOAD' AS PHASE, '{n}' AS TABLE_NAME, NULL AS COLUMN_NAME, 'PRESENT' AS \"CHECK\", 'OK' AS LEVEL, 1 AS N"
            for n in TABLES]
    dates = [f"SELECT 'DATES', TABLE_NAME, COLUMN_NAME, '{c}', {level}, {c} FROM ({q['date_profile']})" for c, level in (
        ("N_8_DIGITS", "'INFO'"), ("N_OTHER", "'INFO'"), ("N_YEAR_GT_2262", "CASE WHEN N_YEAR_GT_2262 > 0 THEN 'WARNING' ELSE 'OK' END"))]
    nulls = [f"SELECT '{phase}', TABLE_NAME, COLUMN_NAME, 'NULLS_' || ACTION, LEVEL, NULLS FROM ({q[name]})"
             for phase, name in (("NULLS_PRE", "nulls_pre"), ("NULLS_POST", "nulls_post"))]
    q["audit_full"] = _union([*load, f"SELECT {columns} FROM ({q['integrity_audit']})", *dates, *nulls])
    return q


def statements() -> dict[str, str]:
    e = etl_ctes(False)
    ed = etl_ctes(True)
    q: dict[str, str] = {}
    q["olap"] = f"{e}\n{OLAP_DOUBLE}"
    q["olap_dirty"] = f"{ed}\n{OLAP_DOUBLE}"
    q["monthly_sales"] = f"{e}\n{_totals(MONTH_KEYS)}"
    q["customer_sales"] = f"{e}\n{_totals(CUSTOMER_KEYS)}"
    q["item_sales"] = f"{e}\n{_totals(ITEM_KEYS)}"
    for name in ("monthly_sales", "customer_sales", "item_sales"):      # merged from monthly state: same rows
        q[f"{name}_parts"] = q[name]
    q["monthly_total"] = f"""{e},
m AS ({_totals(MONTH_KEYS, "DECIMAL(38,4)")})
SELECT ORDER_YEAR, ORDER_MONTH, CAST(sum(TOTAL_REVENUES) AS DOUBLE) AS TOTAL_REVENUES,
  CAST(sum(N_ORDERS) AS BIGINT) AS N_ORDERS FROM m GROUP BY ORDER_YEAR, ORDER_MONTH"""
    q["monthly_history"] = f"""{e},
m AS ({_totals(MONTH_KEYS, "DECIMAL(38,4)")})
SELECT ORDER_YEAR, ORDER_MONTH, CAST(sum(TOTAL_REVENUES) AS DOUBLE) AS REVENUES,
  make_date(ORDER_YEAR, ORDER_MONTH, 1) AS DATE FROM m GROUP BY ORDER_YEAR, ORDER_MONTH"""
    q["revenue_by_company"] = f"""{e}
SELECT ID_COMPANY, CAST(coalesce(sum(VAL_REVENUES), 0) AS DOUBLE) AS VAL_REVENUES,
  CAST(coalesce(sum(VAL_REVENUES), 0) AS DOUBLE) / 1000000.0 AS VAL_REVENUES_MLN
FROM olap WHERE ID_COMPANY IS NOT NULL GROUP BY ID_COMPANY"""
    q["orders_by_country"] = f"""{ed}
SELECT ID_COUNTRY, count(*) AS N_ROWS FROM olap WHERE ID_COUNTRY IS NOT NULL GROUP BY ID_COUNTRY"""
    q["daily_revenue"] = f"""{e}
SELECT ID_ORDER_DATE AS ORDER_DATE, CAST(coalesce(sum(VAL_REVENUES), 0) AS DOUBLE) AS VAL_REVENUES
FROM olap WHERE ID_ORDER_DATE IS NOT NULL GROUP BY ID_ORDER_DATE"""
    q["customer_frequency"] = f"""{e}
SELECT IDS_CUSTOMER, count(ID_ORDER_NUM) AS N_ORDERS,
  CAST(coalesce(sum(VAL_REVENUES), 0) AS DOUBLE) AS TOTAL_REVENUES
FROM olap WHERE IDS_CUSTOMER IS NOT NULL GROUP BY IDS_CUSTOMER"""
    q["rfm"] = f"""{e}
SELECT IDS_CUSTOMER,
  CAST(date_diff('day', max(ID_ORDER_DATE), (SELECT max(ID_ORDER_DATE) FROM olap) + INTERVAL 1 DAY) AS INTEGER) AS Recency,
  count(DISTINCT ID_ORDER_NUM) AS Frequency,
  CAST(coalesce(sum(VAL_REVENUES), 0) AS DOUBLE) AS Monetary
FROM olap WHERE IDS_CUSTOMER IS NOT NULL GROUP BY IDS_CUSTOMER"""
    q["invoice_delay"] = f"""{e}
SELECT ID_ORDER_NUM, IDS_CUSTOMER, CAST(VAL_REVENUES AS DOUBLE) AS VAL_REVENUES,
  CAST(date_diff('day', ID_ORDER_DATE, ID_INVOICE_DATE) AS INTEGER) AS INVOICE_DAYS
FROM olap WHERE ID_ORDER_DATE IS NOT NULL AND ID_INVOICE_DATE IS NOT NULL"""
    q.update(_profiles(e, ed))
    q.update(_forecasts(e))
    q.update(_gbt(e))
    q.update(_cleaning(ed))
    return q
