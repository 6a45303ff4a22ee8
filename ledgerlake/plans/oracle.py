"""DuckDB SQL for the driver's correctness check.

Each query is written independently of the Spark code, from the semantics:
the same bronze mapping (``plans/driver.py``), then the silver, gold, feature
and metric definitions as plain SQL.  Building blocks are named CTEs; a query
names the blocks it needs and ``sql()`` prepends them in dependency order.

Oracle pitfalls handled here: DuckDB's ``strptime`` accepts unpadded digits
and surrounding blanks (Spark's parser does not), ``regexp_replace`` needs
``'g'``, there is no ``initcap``, and DuckDB rounds doubles differently at
exact halves, so means and shares use exact integer arithmetic.
"""

from __future__ import annotations

# Spark pattern -> strptime pattern
_P = {"MM/dd/yyyy": "%m/%d/%Y", "dd/MM/yyyy": "%d/%m/%Y",
      "MMM dd yyyy": "%b %d %Y", "yyyy-MM-dd": "%Y-%m-%d"}
CUST_PATTERNS = ("MM/dd/yyyy", "dd/MM/yyyy", "yyyy-MM-dd")
ACCT_PATTERNS = ("MM/dd/yyyy", "dd/MM/yyyy", "MMM dd yyyy")


def date_text(k: str, d: str) -> str:
    return (f"CASE WHEN {k} % 20 < 6 THEN strftime({d}, '%m/%d/%Y') "
            f"WHEN {k} % 20 < 10 THEN strftime({d}, '%d/%m/%Y') "
            f"WHEN {k} % 20 < 15 THEN strftime({d}, '%b %d %Y') "
            f"WHEN {k} % 20 < 18 THEN strftime({d}, '%Y-%m-%d') "
            f"WHEN {k} % 20 = 18 THEN ' ' || strftime({d}, '%m/%d/%Y') ELSE 'n/a' END")


def parse(s: str, patterns, trim: bool = False) -> str:
    x = f"trim({s})" if trim else s
    tries = ", ".join(f"try_strptime({x}, '{_P[p]}')::DATE" for p in patterns)
    return f"(CASE WHEN {x} = trim({x}) THEN coalesce({tries}) END)"


def initcap(s: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({s}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def amount_text(k: str, price: str) -> str:
    cents = f"CAST(round({price} * 100) AS BIGINT)"
    tail = f"'.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0')"
    return (f"CASE WHEN {k} % 50 = 49 THEN 'N/A' "
            f"WHEN {k} % 3 = 0 THEN format('{{:,}}', {cents} // 100) || {tail} "
            f"ELSE CAST({cents} // 100 AS VARCHAR) || {tail} END")


def mean2(sum_cents: str, n: str) -> str:
    """ROUND(mean, 2) half-up from an exact sum of cents (non-negative)."""
    return f"(CASE WHEN {n} > 0 THEN ((2 * {sum_cents} + {n}) // (2 * {n})) / 100.0 END)"


def share2(n: str, tot: str) -> str:
    """ROUND(n * 100 / tot, 2) half-up, exact."""
    return f"(CASE WHEN {tot} > 0 THEN ((2 * {n} * 10000 + {tot}) // (2 * {tot})) / 100.0 END)"


_TRACKED = ("CustomerName", "Country", "RiskCategory", "KYCStatus", "Occupation")


def _changed(t: str, s: str) -> str:
    ors = " OR ".join(f"{t}.{c} <> {s}.{c}" for c in _TRACKED)
    return f"coalesce(({ors}), false)"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}
#: Blocks that are computed once, however often later ones name them.
COMPUTED: set[str] = set()


def cte(name: str, deps: tuple[str, ...], body: str, computed: bool = False) -> None:
    CTES[name] = (deps, body)
    if computed:
        COMPUTED.add(name)


# ---- bronze mapping ---------------------------------------------------------
cte("t_raw", (), f"""
SELECT CAST(CASE WHEN o_orderkey % 211 = 7 THEN NULL WHEN o_orderkey % 40 = 1 THEN o_orderkey - 1 ELSE o_orderkey END
    AS VARCHAR) AS TransactionID,
  CAST(o_custkey AS VARCHAR) AS CustomerID, CAST(o_custkey + 1000000 AS VARCHAR) AS AccountID,
  {date_text('o_orderkey', 'CAST(o_orderdate AS DATE)')} AS TransactionDate,
  {amount_text('o_orderkey', 'o_totalprice')} AS Amount,
  o_orderstatus AS TransactionType, o_orderpriority AS Channel,
  CASE WHEN o_orderkey % 10 = 3 THEN n_name || ' ' ELSE n_name END AS DestinationCountry,
  CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' END AS IsFraud,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '1' ELSE '0' END AS IsLaundered,
  CAST(o_orderkey % 100 AS VARCHAR) AS RiskScore,
  CAST(o_orderdate AS DATE) AS true_date
FROM orders LEFT JOIN nation ON o_orderkey % 25 = n_nationkey""")

cte("c_attr", (), """
SELECT c_custkey,
  CASE WHEN c_custkey % 50 IN (10, 11) THEN 'Shared @Name' WHEN c_custkey % 5 = 0 THEN regexp_replace(c_name, '#', '@#', 'g') ELSE c_name END AS CustomerName,
  CASE c_custkey % 3 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) || ' ' ELSE '  ' || n_name END AS Country,
  c_mktsegment
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")

cte("c_obs", ("c_attr",), f"""
SELECT CAST(CASE WHEN o_orderkey % 199 <> 4 THEN o_custkey END AS VARCHAR) AS CustomerID, a.CustomerName, a.Country,
  o_orderpriority AS RiskCategory, o_orderstatus AS KYCStatus, a.c_mktsegment AS Occupation,
  {date_text('o_orderkey', 'CAST(o_orderdate AS DATE)')} AS EffectiveDate,
  CAST(o_orderdate AS DATE) AS true_date
FROM orders JOIN c_attr a ON o_custkey = a.c_custkey""")

_C_COLS = "CustomerID, CustomerName, Country, RiskCategory, KYCStatus, Occupation, EffectiveDate"
cte("c_raw0", ("c_obs",), f"""
SELECT {_C_COLS}, TIMESTAMP '1996-06-01 00:00:00' AS IngestionDate, 'driver/orders' AS SourceFile
FROM c_obs WHERE true_date < DATE '1996-06-01'""")
cte("c_raw1", ("c_obs", "c_raw0"), f"""
SELECT * FROM c_raw0 UNION ALL
SELECT {_C_COLS}, TIMESTAMP '1998-01-01 00:00:00', 'driver/orders'
FROM c_obs WHERE true_date >= DATE '1996-06-01' AND true_date < DATE '1998-01-01'""")
cte("c_raw2", ("c_obs", "c_raw1"), f"""
SELECT * FROM c_raw1 UNION ALL
SELECT {_C_COLS}, TIMESTAMP '2001-09-01 00:00:00', 'driver/orders'
FROM c_obs WHERE true_date IS NULL OR true_date >= DATE '1998-01-01'""")

cte("a_raw", (), f"""
SELECT CAST(CASE WHEN c_custkey % 97 <> 3 THEN c_custkey + 1000000 END AS VARCHAR) AS AccountID,
  CAST(c_custkey AS VARCHAR) AS CustomerID, CASE WHEN n = 1 THEN lower(c_mktsegment) ELSE c_mktsegment END AS AccountType,
  CASE c_custkey % 4 WHEN 0 THEN 'UGX' WHEN 1 THEN 'usd' WHEN 2 THEN 'UGX ' ELSE 'USD' END AS Currency,
  {date_text('(c_custkey + 3 * n)', "(DATE '1990-01-01' + CAST(c_custkey % 1500 + 400 * n AS INTEGER))")} AS OpenDate
FROM customer, (SELECT unnest([0, 1]) AS n) WHERE n = 0 OR c_custkey % 7 = 0""")


# ---- silver customer (SCD2, two runs) --------------------------------------
def _c_stage(src: str) -> str:
    eff = parse("EffectiveDate", CUST_PATTERNS, trim=True)
    return f"""
SELECT CustomerID, replace(CustomerName, '@', '') AS CustomerName, {initcap('trim(Country)')} AS Country,
  RiskCategory, KYCStatus, Occupation, {eff} AS EffectiveDate, IngestionDate,
  CASE WHEN {eff} IS NULL THEN 'InvalidEffectiveDate' ELSE 'ValidDate' END AS QualityCheck
FROM {src}"""


def _c_ranked(src: str) -> str:
    return f"""
SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY IngestionDate DESC NULLS LAST,
  EffectiveDate DESC NULLS LAST, CustomerName NULLS FIRST, Country NULLS FIRST,
  RiskCategory NULLS FIRST, KYCStatus NULLS FIRST, Occupation NULLS FIRST, QualityCheck NULLS FIRST) AS rn
FROM {src}"""


# Rows without a key match nothing; they are counted by the query ``rejects``.
for _n in "012":
    cte(f"c_stage{_n}", (f"c_raw{_n}",), _c_stage(f"c_raw{_n}"))
    cte(f"c_ranked{_n}", (f"c_stage{_n}",), _c_ranked(f"c_stage{_n}"))
    cte(f"c_src{_n}", (f"c_ranked{_n}",),
        f"SELECT * FROM c_ranked{_n} WHERE rn = 1 AND QualityCheck = 'ValidDate' AND CustomerID IS NOT NULL")

cte("dim0", ("c_src0",), """
SELECT row_number() OVER (ORDER BY CustomerID, EffectiveDate) AS CustomerSK, CustomerID, CustomerName,
  Country, RiskCategory, KYCStatus, Occupation, EffectiveDate AS StartDate,
  CAST(NULL AS DATE) AS EndDate, true AS IsCurrent
FROM c_src0""")


def _c_run(old: str, src: str, new: str) -> None:
    """The SCD2 merge of ``src`` into ``old``: ``<old>_closed`` and ``new``."""
    cte(f"{old}_closed", (old, src), f"""
SELECT t.CustomerSK, t.CustomerID, t.CustomerName, t.Country, t.RiskCategory, t.KYCStatus, t.Occupation,
  t.StartDate,
  CASE WHEN s.CustomerID IS NOT NULL AND {_changed('t', 's')} THEN s.EffectiveDate ELSE t.EndDate END AS EndDate,
  CASE WHEN s.CustomerID IS NOT NULL AND {_changed('t', 's')} THEN false ELSE t.IsCurrent END AS IsCurrent
FROM {old} t LEFT JOIN {src} s ON t.CustomerID = s.CustomerID AND t.IsCurrent""")
    cte(f"{new}_new", (old, src), f"""
SELECT s.* FROM {src} s LEFT JOIN (SELECT * FROM {old} WHERE IsCurrent) t ON s.CustomerID = t.CustomerID
WHERE t.CustomerID IS NULL OR {_changed('t', 's')}""")
    cte(new, (f"{old}_closed", f"{new}_new", old), f"""
SELECT * FROM {old}_closed UNION ALL
SELECT (SELECT coalesce(max(CustomerSK), 0) FROM {old}) + row_number() OVER (ORDER BY CustomerID, EffectiveDate),
  CustomerID, CustomerName, Country, RiskCategory, KYCStatus, Occupation, EffectiveDate,
  CAST(NULL AS DATE), true
FROM {new}_new""")


_c_run("dim0", "c_src1", "dim1")
_c_run("dim1", "c_src2", "dim2")


# ---- silver account (SCD1) -------------------------------------------------
def _a_stage(src: str) -> str:
    od = parse("OpenDate", ACCT_PATTERNS)
    return f"""
SELECT a.AccountID, c.CustomerSK, a.AccountType, {initcap('a.Currency')} AS Currency, {od} AS OpenDate,
  CASE WHEN {od} IS NULL THEN 'InvalidOpenDate' ELSE 'ValidOpenDate' END AS QualityCheck
FROM {src} a LEFT JOIN (SELECT CustomerID, CustomerSK FROM dim2 WHERE IsCurrent) c ON a.CustomerID = c.CustomerID"""


def _a_dedup(src: str) -> str:
    return f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY AccountID ORDER BY OpenDate DESC NULLS LAST,
  CustomerSK NULLS FIRST, AccountType NULLS FIRST, Currency NULLS FIRST, QualityCheck NULLS FIRST) AS rn
  FROM {src}) WHERE rn = 1 AND QualityCheck = 'ValidOpenDate' AND AccountID IS NOT NULL"""


cte("a_stage", ("a_raw", "dim2"), _a_stage("a_raw"))
cte("a_src", ("a_stage",), _a_dedup("a_stage"))
cte("acct", ("a_src",), """
SELECT row_number() OVER (ORDER BY AccountID) AS AccountSK, AccountID, CustomerSK, AccountType, Currency, OpenDate
FROM a_src""")


# ---- silver fact -------------------------------------------------------------
def _t_parsed(src: str) -> str:
    return f"""
SELECT TransactionID, CustomerID, AccountID, {parse('TransactionDate', ACCT_PATTERNS)} AS TransactionDate,
  try_cast(replace(Amount, ',', '') AS DECIMAL(10,2)) AS Amount, TransactionType, Channel,
  DestinationCountry, IsFraud, IsLaundered, RiskScore, true_date
FROM {src}"""


def _t_staged(src: str, acct: str = "acct") -> str:
    return f"""
SELECT p.TransactionID, p.CustomerID, p.AccountID, c.CustomerSK, a.AccountSK, p.TransactionDate, p.Amount, p.TransactionType,
  p.Channel, p.DestinationCountry, p.IsFraud, p.IsLaundered, p.RiskScore, c.StartDate AS asof_start
FROM {src} p
LEFT JOIN dim2 c ON p.CustomerID = c.CustomerID AND p.TransactionDate >= c.StartDate
  AND (p.TransactionDate <= c.EndDate OR c.EndDate IS NULL)
LEFT JOIN {acct} a ON p.AccountID = a.AccountID"""


def _t_dedup(src: str) -> str:
    return f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY TransactionID ORDER BY TransactionDate DESC NULLS LAST,
  asof_start DESC NULLS LAST, CustomerID NULLS FIRST, AccountID NULLS FIRST, Amount NULLS FIRST,
  TransactionType NULLS FIRST, Channel NULLS FIRST, DestinationCountry NULLS FIRST, IsFraud NULLS FIRST,
  IsLaundered NULLS FIRST, RiskScore NULLS FIRST, CustomerSK NULLS FIRST, AccountSK NULLS FIRST) AS rn FROM {src}) WHERE rn = 1"""


def _t_typed(src: str) -> str:
    return f"""
SELECT TransactionID, CustomerSK, AccountSK, TransactionDate, Amount, TransactionType, Channel,
  DestinationCountry, try_cast(IsFraud AS BOOLEAN) AS IsFraud, try_cast(IsLaundered AS BOOLEAN) AS IsLaundered,
  try_cast(RiskScore AS INTEGER) AS RiskScore
FROM {src} WHERE TransactionID IS NOT NULL"""


cte("t_parsed", ("t_raw",), _t_parsed("t_raw"))
cte("t_staged", ("t_parsed", "dim2", "acct"), _t_staged("t_parsed"))
cte("t_dedup", ("t_staged",), _t_dedup("t_staged"))
cte("fact", ("t_dedup",), _t_typed("t_dedup"))

# ---- features ---------------------------------------------------------------
cte("feat_base", ("fact", "dim2"), """
SELECT f.TransactionID, d.CustomerSK, f.AccountSK, f.TransactionDate, f.Amount, f.TransactionType, f.Channel,
  f.DestinationCountry, f.IsFraud, f.IsLaundered, f.RiskScore, d.StartDate AS start_date,
  CAST(round(f.Amount * 100) AS BIGINT) AS cents
FROM fact f LEFT JOIN dim2 d ON f.CustomerSK = d.CustomerSK
WHERE f.CustomerSK IS NOT NULL""")
cte("feat_win", ("feat_base",), """
SELECT *,
  count(*) OVER (PARTITION BY CustomerSK ORDER BY TransactionDate
    RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS c7,
  sum(cents) OVER (PARTITION BY CustomerSK ORDER BY TransactionDate
    RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW) AS s30,
  count(Amount) OVER (PARTITION BY CustomerSK ORDER BY TransactionDate
    RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW) AS n30
FROM feat_base""")
cte("features", ("feat_win",), f"""
SELECT TransactionID, CustomerSK, AccountSK, TransactionDate, CAST(Amount AS DOUBLE) AS Amount, TransactionType,
  Channel, DestinationCountry, IsFraud, IsLaundered, CAST(RiskScore AS BIGINT) AS RiskScore,
  c7 AS TxnCount_Last_7_Days,
  {mean2('s30', 'n30')} AS AvgAmount_Last_30_Days,
  CASE WHEN n30 = 0 OR s30 = 0 THEN NULL
       ELSE round(cents * 1.0 * n30 / s30, 6) END AS Amount_vs_Avg,
  CAST(CASE WHEN DestinationCountry <> 'NATION_0' THEN 1 ELSE 0 END AS BIGINT) AS IsForeignTransaction,
  CAST(date_diff('day', start_date, TransactionDate) AS BIGINT) AS CustomerTenure
FROM feat_win""")


def sql(body: str, *names: str) -> str:
    """Prepend the named CTEs (and their dependencies) to ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in COMPUTED else ''}({CTES[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{body.strip()}"


# ---- closed-form fits -------------------------------------------------------------
#
# The elimination of ``operators.closed_form`` written out: one CTE per pivot, columns
# a_i_j and b_i; then the unknowns from the last to the first.

def elimination(name: str, source: str, n: int) -> list[str]:
    """CTEs that solve the system in the one row of ``source`` (a_i_j, b_i); ``{name}_x`` has x0, x1, ..."""
    cells = [f"a_{i}_{j}" for i in range(n) for j in range(n)] + [f"b_{i}" for i in range(n)]
    steps = [f"{name}_0 AS (SELECT {', '.join(cells)}, {', '.join(f'a_{i}_{i} AS d_{i}' for i in range(n))} FROM {source})"]
    diagonal = ", ".join(f"d_{i}" for i in range(n))
    for k in range(n):
        sound = f"a_{k}_{k} > 1e-12::DOUBLE * d_{k}"
        factor = [f"CASE WHEN {sound} THEN a_{i}_{k} / a_{k}_{k} ELSE 0.0::DOUBLE END AS f_{i}" for i in range(k + 1, n)]
        change = [f"a_{i}_{j} - f_{i} * a_{k}_{j} AS a_{i}_{j}" if i > k and j >= k else f"a_{i}_{j}" for i in range(n) for j in range(n)]
        change += [f"b_{i} - f_{i} * b_{k} AS b_{i}" if i > k else f"b_{i}" for i in range(n)]
        steps.append(f"{name}_{k + 1} AS MATERIALIZED (SELECT {', '.join(change)}, {diagonal} FROM (SELECT *{', ' if factor else ''}{', '.join(factor)} FROM {name}_{k}))")
    source = f"{name}_{n}"
    for k in range(n - 1, -1, -1):
        rest = f"b_{k}" + "".join(f" - a_{k}_{j} * x{j}" for j in range(k + 1, n))
        known = "".join(f", x{j}" for j in range(k + 1, n))
        steps.append(f"{name}_x{k if k else ''} AS MATERIALIZED (SELECT {', '.join(cells)}, {diagonal}{known}, CASE WHEN a_{k}_{k} > 1e-12::DOUBLE * d_{k} "
                     f"THEN ({rest}) / a_{k}_{k} ELSE 0.0::DOUBLE END AS x{k} FROM {source})")
        source = f"{name}_x{k if k else ''}"
    return steps


def linear_fit(rows: str, inputs) -> list[str]:
    """CTE ``ols`` with x0.. (coefficients by input) and ``icept``, from ``rows`` (label and inputs as DECIMAL(18,6) in c0.., c_n)."""
    k = len(inputs)
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1 if i < k else i)]
    sums = ", ".join([f"sum(c{i}) AS s{i}" for i in range(k + 1)] + [f"sum(CAST(c{i} AS DECIMAL(19,6)) * CAST(c{j} AS DECIMAL(19,6))) AS q_{i}_{j}" for i, j in pairs])
    means = ", ".join(f"CAST(s{i} AS DOUBLE) / n AS m{i}" for i in range(k + 1))
    cov = [f"CAST(q_{min(i, j)}_{max(i, j)} AS DOUBLE) / n - m{min(i, j)} * m{max(i, j)} AS a_{i}_{j}" for i in range(k) for j in range(k)]
    cov += [f"CAST(q_{i}_{k} AS DOUBLE) / n - m{i} * m{k} AS b_{i}" for i in range(k)]
    return [f"ols_sums AS MATERIALIZED (SELECT count(*)::DOUBLE AS n, {sums} FROM {rows})", f"ols_means AS (SELECT *, {means} FROM ols_sums)",
            f"ols_cov AS MATERIALIZED (SELECT {', '.join(cov)} FROM ols_means)", *elimination("ols_e", "ols_cov", k),
            f"ols AS MATERIALIZED (SELECT x.*, m{k}{''.join(f' - x{i} * m{i}' for i in range(k))} AS icept FROM ols_e_x x, ols_means)"]


def logistic_fit(rows: str, inputs, steps: int) -> list[str]:
    """CTE ``logit`` with w0 (intercept), w1.. after Newton steps, from ``rows`` (label ``y`` and inputs c0.. as DOUBLE)."""
    k = len(inputs)
    names = ["1.0::DOUBLE", *(f"c{i}" for i in range(k))]
    out = [f"newton_0 AS (SELECT {', '.join(f'0.0::DOUBLE AS w{i}' for i in range(k + 1))})"]
    for t in range(steps):
        z = "w0" + "".join(f" + w{i + 1} * c{i}" for i in range(k))
        grad = [f"sum(r * {names[i]}) + any_value({f'w{i}' if i else '0.0::DOUBLE'}) AS b_{i}" for i in range(k + 1)]
        hess = [f"sum(v * {names[min(i, j)]} * {names[max(i, j)]}){' + 1.0' if i == j and i else ''} AS a_{i}_{j}" for i in range(k + 1) for j in range(k + 1)]
        out.append(f"newton_p{t} AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({z}))) AS p FROM {rows}, newton_{t})")
        out.append(f"newton_h{t} AS MATERIALIZED (SELECT {', '.join(grad + hess)} FROM (SELECT *, p - y AS r, p * (1.0::DOUBLE - p) AS v FROM newton_p{t}))")
        out += elimination(f"newton_e{t}", f"newton_h{t}", k + 1)
        out.append(f"newton_{t + 1} AS MATERIALIZED (SELECT {', '.join(f'w{i} - x{i} AS w{i}' for i in range(k + 1))} FROM newton_{t}, newton_e{t}_x)")
    out.append(f"logit AS (SELECT * FROM newton_{steps})")
    return out
