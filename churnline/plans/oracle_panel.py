"""The customer snapshots and the feature table as plain SQL, for checking."""

from churnline.schema import INTERNET_ADD_ONS, ONE_HOT_PREFIX

_ADD_ON_PART_TYPES = ["ECONOMY", "MEDIUM", "STANDARD", "LARGE", "SMALL", "PROMO"]
_SERVICE_LEVELS = ["No", "No internet service", "Yes"]

# The levels found in the given tables.
LEVELS = {
    "InternetService": ["DSL", "Fiber optic", "No"],
    "PaymentMethod": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "MultipleLines": ["No", "No phone service", "Yes"],
    **{c: _SERVICE_LEVELS for c in INTERNET_ADD_ONS},
}


def _raw() -> str:
    dates = ", ".join(f"(TIMESTAMP '{y}-{m}-01')" for y in range(1996, 2001) for m in ("01", "07") if (y, m) < (2000, "08"))
    add_ons = ",\n".join(
        f"CASE WHEN status = 'P' THEN 'No internet service' WHEN coalesce(has_{t.lower()}, 0) = 1 THEN 'Yes' ELSE 'No' END AS {c}"
        for c, t in zip(INTERNET_ADD_ONS, _ADD_ON_PART_TYPES)
    )
    flags = ", ".join(f"max(CASE WHEN p_type = '{t}' THEN 1 ELSE 0 END) AS has_{t.lower()}" for t in _ADD_ON_PART_TYPES)
    return f"""
obs(obs_date) AS (VALUES {dates}),
past AS (
  SELECT o.*, obs_date, o_orderdate >= obs_date - INTERVAL 12 MONTH AS in_year,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         row_number() OVER (PARTITION BY o_custkey, obs_date ORDER BY o_orderdate DESC, o_orderkey DESC) AS recency
  FROM orders o JOIN obs ON o_orderdate < obs_date),
summary AS (
  SELECT o_custkey, obs_date,
         (year(obs_date) * 12 + month(obs_date)) - (year(min(o_orderdate)) * 12 + month(min(o_orderdate))) AS tenure,
         count(*) FILTER (in_year) AS year_n,
         coalesce(sum(cents) FILTER (in_year), 0) AS year_cents, sum(cents) AS past_cents,
         max(o_orderstatus) FILTER (recency = 1) AS status,
         max(substr(o_orderpriority, 1, 1)) FILTER (recency = 1) AS priority
  FROM past GROUP BY o_custkey, obs_date),
add_ons AS (
  SELECT o_custkey, obs_date, {flags}
  FROM past JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
  WHERE in_year GROUP BY o_custkey, obs_date),
later AS (
  SELECT DISTINCT o_custkey, obs_date FROM orders JOIN obs
  ON o_orderdate >= obs_date AND o_orderdate < obs_date + INTERVAL 12 MONTH),
buyers AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'),
raw AS (
  SELECT c_custkey, strftime(s.obs_date, '%Y-%m-%d') AS obs_date,
    c_custkey || '-' || strftime(s.obs_date, '%Y-%m-%d') AS customerID,
    CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS SeniorCitizen,
    CASE WHEN c_nationkey % 2 = 1 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN r_name IN ('AFRICA', 'AMERICA') THEN 'Yes' ELSE 'No' END AS Dependents,
    CAST(tenure AS INTEGER) AS tenure,
    CASE WHEN year_n > 0 THEN 'Yes' ELSE 'No' END AS PhoneService,
    CASE WHEN year_n = 0 THEN 'No phone service' WHEN year_n >= 2 THEN 'Yes' ELSE 'No' END AS MultipleLines,
    CASE status WHEN 'F' THEN 'Fiber optic' WHEN 'O' THEN 'DSL' ELSE 'No' END AS InternetService,
    {add_ons},
    CASE WHEN priority IN ('1', '2') THEN 'Month-to-month' WHEN priority = '3' THEN 'One year' ELSE 'Two year' END AS Contract,
    CASE WHEN b.user_id IS NOT NULL THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    c_mktsegment AS PaymentMethod,
    (CAST(year_cents AS BIGINT) // 5040) / 100.0::DOUBLE AS MonthlyCharges,
    CASE WHEN tenure <= 1 THEN ' ' ELSE CAST(CAST(past_cents AS BIGINT) // 42000 AS VARCHAR) END AS TotalCharges,
    CASE WHEN l.o_custkey IS NULL THEN 'Yes' ELSE 'No' END AS Churn
  FROM summary s JOIN customer ON c_custkey = s.o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
  LEFT JOIN add_ons a ON a.o_custkey = s.o_custkey AND a.obs_date = s.obs_date
  LEFT JOIN later l ON l.o_custkey = s.o_custkey AND l.obs_date = s.obs_date
  LEFT JOIN buyers b ON b.user_id = c_custkey)"""


def column_name(text: str) -> str:
    return "".join(ch if ch.isalnum() and ch.isascii() or ch == "_" else "_" for ch in text)


def one_hot_names() -> list[str]:
    return [column_name(f"{ONE_HOT_PREFIX[c]}_{level}") for c in ONE_HOT_PREFIX for level in LEVELS[c]]


BUCKET_NAMES = ["tb_0_12", "tb_13_24", "tb_25_48", "tb_49_"]
FEATURES = [
    "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService", "PaperlessBilling",
    "MonthlyCharges", "TotalCharges", "avg_monthly_charges", "active_services", "charges_per_service",
    "is_high_value", "Contract_ord", *one_hot_names(), *BUCKET_NAMES,
]


def _features() -> str:
    yes = lambda c: f"CASE WHEN lower(trim({c})) = 'yes' THEN 1 ELSE 0 END"
    services = " + ".join(f"({yes(c)})" for c in ["PhoneService", "MultipleLines", *INTERNET_ADD_ONS])
    one_hot = ",\n".join(
        f"CASE WHEN {c} = '{level}' THEN 1 ELSE 0 END AS {column_name(f'{ONE_HOT_PREFIX[c]}_{level}')}"
        for c in ONE_HOT_PREFIX
        for level in LEVELS[c]
    )
    return f"""
named AS (
  SELECT * REPLACE (CASE WHEN trim(TotalCharges) = '' THEN 0.0 ELSE CAST(TotalCharges AS DOUBLE) END AS TotalCharges,
                    {yes("Churn")} AS Churn),
    CAST({services} AS INTEGER) AS active_services,
    CASE WHEN tenure < 0 THEN NULL WHEN tenure <= 12 THEN '0-12' WHEN tenure <= 24 THEN '13-24'
         WHEN tenure <= 48 THEN '25-48' ELSE '49+' END AS tenure_bucket,
    CASE WHEN MonthlyCharges > 70 THEN 1 ELSE 0 END AS is_high_value
  FROM raw),
features AS (
  SELECT customerID,
    CASE WHEN lower(trim(gender)) = 'male' THEN 1 ELSE 0 END AS gender, SeniorCitizen,
    {yes("Partner")} AS Partner, {yes("Dependents")} AS Dependents, tenure,
    {yes("PhoneService")} AS PhoneService, {yes("PaperlessBilling")} AS PaperlessBilling,
    MonthlyCharges, TotalCharges, Churn,
    TotalCharges / (tenure + 1) AS avg_monthly_charges, active_services,
    MonthlyCharges / (active_services + 1) AS charges_per_service, is_high_value,
    CASE Contract WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 2 END AS Contract_ord,
    {one_hot},
    CASE WHEN tenure_bucket = '0-12' THEN 1 ELSE 0 END AS tb_0_12,
    CASE WHEN tenure_bucket = '13-24' THEN 1 ELSE 0 END AS tb_13_24,
    CASE WHEN tenure_bucket = '25-48' THEN 1 ELSE 0 END AS tb_25_48,
    CASE WHEN tenure_bucket = '49+' THEN 1 ELSE 0 END AS tb_49_
  FROM named)"""


RAW = f"WITH {_raw().strip()}\n"
FEATURES_CTE = f"{RAW.rstrip()},\n{_features().strip()}\n"
