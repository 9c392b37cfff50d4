"""SQL counterparts of the registered queries, for an independent engine."""

from __future__ import annotations

from wanderlake.fixed_values import SURROGATE_NULL
from wanderlake.sources.fixtures import CLAIM_TYPES, COUNTRIES, DESTINATIONS

AS_OF = "TIMESTAMP '2025-06-30 12:00:00'"
EVENTS_AS_OF = "TIMESTAMP '2029-07-30 00:30:00'"
LANDING_AS_OF = "TIMESTAMP '2024-01-30 23:59:00'"
CUT = "TIMESTAMP '2026-01-01 00:00:00'"
PUBLISHED = f"created_at >= {EVENTS_AS_OF} - INTERVAL 8760 HOUR"
PUBLISHED_FIRST = "created_at <= TIMESTAMP '2029-01-30 00:00:00'"


def _items(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


# Fixed values, written out here as well, so that a wrong one in the library shows.
ISO_CODE = """CASE {}
    WHEN 'UNITED KINGDOM' THEN 'GB'
    WHEN 'UNITED STATES' THEN 'US'
    WHEN 'FRANCE' THEN 'FR'
    WHEN 'GERMANY' THEN 'DE'
    WHEN 'SPAIN' THEN 'ES'
    WHEN 'ITALY' THEN 'IT'
    WHEN 'AUSTRALIA' THEN 'AU'
    WHEN 'CANADA' THEN 'CA'
    WHEN 'INDIA' THEN 'IN'
    WHEN 'JAPAN' THEN 'JP'
    WHEN 'BRAZIL' THEN 'BR'
    WHEN 'NETHERLANDS' THEN 'NL'
    WHEN 'SWEDEN' THEN 'SE'
    WHEN 'NORWAY' THEN 'NO'
    WHEN 'UAE' THEN 'AE'
    WHEN 'SINGAPORE' THEN 'SG'
    WHEN 'SOUTH AFRICA' THEN 'ZA'
    WHEN 'THAILAND' THEN 'TH'
    WHEN 'MEXICO' THEN 'MX'
    WHEN 'IRELAND' THEN 'IE'
    ELSE 'UN' END"""
CONTINENT = """CASE {}
    WHEN 'THAILAND' THEN 'Asia'
    WHEN 'SPAIN' THEN 'Europe'
    WHEN 'USA' THEN 'North America'
    WHEN 'JAPAN' THEN 'Asia'
    WHEN 'AUSTRALIA' THEN 'Oceania'
    WHEN 'UAE' THEN 'Middle East'
    WHEN 'FRANCE' THEN 'Europe'
    WHEN 'ITALY' THEN 'Europe'
    WHEN 'MALDIVES' THEN 'Asia'
    WHEN 'UK' THEN 'Europe'
    ELSE 'Other' END"""


def _key(expression: str) -> str:
    return f"md5(coalesce(CAST({expression} AS VARCHAR), '{SURROGATE_NULL}'))"


def _latest(source: str, partition: str, by: list[str], rest: list[str], unknown_first: bool) -> str:
    nulls = "FIRST" if unknown_first else "LAST"
    order = [f"{c} DESC NULLS {nulls}" for c in by] + [f"{c} DESC NULLS LAST" for c in rest]
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {partition} "
        f"ORDER BY {', '.join(order)}) AS row_rank FROM {source}) WHERE row_rank = 1"
    )


RAW_CUSTOMERS = f"""
SELECT c_custkey AS customer_id,
       '  ' || split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) || CASE WHEN v = 1 THEN '-B ' ELSE ' ' END AS last_name,
       '  ' || upper(c_name) || '@EXAMPLE.COM ' AS email,
       CASE WHEN c_custkey % 61 <> 0
            THEN DATE '1955-01-01' + CAST(c_custkey * 37 % 18600 AS INTEGER) END AS date_of_birth,
       list_extract({_items(COUNTRIES)}, c_custkey % 22 + 1) AS country_of_residence,
       CASE WHEN c_custkey % 7 <> 0 THEN ' +44-' || CAST(c_custkey AS VARCHAR) || ' ' END AS phone,
       TIMESTAMP '2023-01-01 00:00:00' + to_hours(CAST(c_custkey + v * 24 AS INTEGER)) AS created_at
FROM (SELECT *, unnest(CASE WHEN c_custkey % 10 = 0 THEN [0, 1] ELSE [0] END) AS v FROM customer)
"""

RAW_POLICIES = f"""
SELECT o_orderkey AS policy_id,
       o_custkey AS customer_id,
       ' POL-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || ' ' AS policy_number,
       CASE WHEN o_custkey % 41 <> 0
            THEN list_extract({_items(DESTINATIONS)}, o_custkey % 11 + 1) END AS destination_country,
       CAST(o_orderdate AS DATE) + 10227 AS trip_start_date,
       CAST(o_orderdate AS DATE) + 10227 + CAST(o_orderkey % 29 + 2 AS INTEGER) AS trip_end_date,
       CASE o_orderpriority WHEN '1-URGENT' THEN ' Medical' WHEN '2-HIGH' THEN 'cancellation '
            WHEN '3-MEDIUM' THEN 'BAGGAGE' ELSE 'comprehensive' END AS coverage_type,
       CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'n/a'
            ELSE CAST(o_totalprice AS VARCHAR) END AS premium_amount,
       CASE WHEN v = 1 THEN 'active ' WHEN o_orderstatus = 'P' THEN 'Active'
            WHEN o_orderstatus = 'F' THEN ' EXPIRED' ELSE 'cancelled ' END AS status,
       o_orderkey % 120 AS broker_id,
       o_orderdate + to_days(CAST(10227 + v * 3 AS INTEGER)) + to_seconds(o_orderkey % 86400) AS created_at
FROM (SELECT *, unnest(CASE WHEN o_orderkey % 20 = 0 THEN [0, 1] ELSE [0] END) AS v FROM orders)
"""

RAW_CLAIMS = f"""
SELECT l_orderkey * 10 + l_linenumber AS claim_id,
       l_orderkey AS policy_id,
       list_extract({_items(CLAIM_TYPES)}, l_partkey % 4 + 1) AS claim_type,
       CASE WHEN l_partkey % 211 = 0 THEN '0' WHEN l_partkey % 223 = 0 THEN '-12.505'
            WHEN l_partkey % 199 = 0 THEN 'n/a' ELSE CAST(l_extendedprice AS VARCHAR) END AS claim_amount,
       CAST(l_shipdate AS DATE) + 10227 AS claim_date,
       CASE l_returnflag WHEN 'A' THEN 'Approved ' WHEN 'R' THEN ' rejected' ELSE 'PENDING' END AS status,
       CASE WHEN l_suppkey % 3 <> 0 THEN 'line ' || l_linestatus END AS description,
       CASE WHEN l_returnflag <> 'N'
            THEN CAST(CAST(l_shipdate AS DATE) + 10227 AS TIMESTAMP)
                 + to_days(CAST(l_suppkey % 30 AS INTEGER)) + to_seconds(l_partkey % 86400)
       END AS processed_at,
       l_shipdate + to_days(10227) + to_seconds(l_partkey % 86400) AS created_at
FROM lineitem
"""

RAW_BROKERS = """
SELECT s_suppkey AS broker_id,
       ' ' || s_name AS broker_name,
       'Company ' || CAST(s_suppkey % 7 AS VARCHAR) || ' ' AS broker_company,
       n_name || ' ' AS country,
       s_suppkey % 40 + 1 AS policies_sold_today,
       CAST(CAST(abs(s_acctbal) AS DECIMAL(12, 2)) * (v + 1) * 10 AS DECIMAL(12, 2)) AS total_premium_value,
       CAST(s_suppkey % 16 + 5 AS DOUBLE) / 100.0 AS commission_rate,
       CAST(CAST(CAST(abs(s_acctbal) AS DECIMAL(12, 2)) * (v + 1) * 10 AS DECIMAL(12, 2))
            * CAST(CAST(s_suppkey % 16 + 5 AS DECIMAL(4, 0)) * 0.01 AS DECIMAL(5, 2)) AS DECIMAL(12, 2))
           AS commission_earned,
       DATE '2024-01-01' + v AS report_date
FROM (SELECT *, unnest([0, 1]) AS v FROM supplier) LEFT JOIN nation ON s_nationkey = n_nationkey
"""

RAW_FLIGHTS = """
SELECT 'u' || CAST(user_id AS VARCHAR) AS icao24,
       CASE WHEN event_id % 9 = 0 THEN '   ' ELSE ' FL' || CAST(event_id AS VARCHAR) || ' ' END AS callsign,
       event_type || ' ' AS origin_country,
       CAST(event_id % 360 - 180 AS DOUBLE) AS longitude,
       CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 11 AS DOUBLE) END AS latitude,
       "value" AS altitude,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS velocity,
       CAST(event_id % 360 AS DOUBLE) AS heading,
       CASE event_type WHEN 'click' THEN 'TRUE' WHEN 'view' THEN '1' WHEN 'error' THEN 'no'
            WHEN 'purchase' THEN 'Yes' END AS on_ground,
       ts AS event_timestamp,
       ts + to_seconds(event_id % 120) AS ingested_at,
       event_id
FROM events
"""

CUSTOMER_REST = [
    "first_name", "last_name", "email", "date_of_birth", "country_of_residence", "phone",
]
POLICY_REST = [
    "customer_id", "policy_number", "destination_country", "trip_start_date", "trip_end_date",
    "coverage_type", "premium_amount", "status", "broker_id",
]
CLAIM_REST = [
    "policy_id", "claim_type", "claim_amount", "claim_date", "status", "description", "processed_at",
]
FLIGHT_COLUMNS = [
    "icao24", "callsign", "origin_country", "longitude", "latitude", "altitude", "velocity",
    "heading", "on_ground", "event_timestamp", "ingested_at",
]


def _clean_flights(seconds: int, source: str = "raw_flights") -> str:
    rest = [c for c in FLIGHT_COLUMNS if c not in ("icao24", "event_timestamp")]
    latest = _latest(
        source,
        f"icao24, CAST(floor(epoch(event_timestamp) / {seconds}) AS BIGINT)",
        ["event_timestamp"],
        rest,
        unknown_first=False,
    )
    return f"""
SELECT icao24, callsign, origin_country, longitude, latitude, altitude, velocity, heading,
       coalesce(lower(CAST(on_ground AS VARCHAR)) IN ('true', '1', 'yes'), FALSE) AS on_ground,
       event_timestamp, {LANDING_AS_OF} AS ingested_at
FROM ({latest}) WHERE latitude IS NOT NULL AND longitude IS NOT NULL
"""


CLEAN_POLICIES = f"""
SELECT policy_id, customer_id, trim(policy_number) AS policy_number,
       trim(destination_country) AS destination_country, trip_start_date, trip_end_date,
       trim(coverage_type) AS coverage_type,
       TRY_CAST(trim(premium_amount) AS DECIMAL(10, 2)) AS premium_amount,
       trim(status) AS status, broker_id, created_at
FROM ({_latest("raw_policies", "policy_number", ["created_at"],
               ["policy_id", *[c for c in POLICY_REST if c != "policy_number"]], False)})
"""

def _daily_stats(source: str) -> str:
    return f"""
SELECT CAST(event_timestamp AS DATE) AS flight_day, origin_country, count(*) AS flight_count,
       round(avg(altitude), 9) AS avg_altitude, round(avg(velocity), 9) AS avg_velocity,
       round(avg(CAST(on_ground AS INTEGER)) * 100, 9) AS pct_on_ground
FROM {source} GROUP BY ALL
"""


STG_CUSTOMERS = f"""
SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
       lower(trim(email)) AS email, date_of_birth, trim(country_of_residence) AS country_of_residence,
       {ISO_CODE.format("upper(trim(country_of_residence))")} AS country_iso_code,
       trim(phone) AS phone, created_at, trim(first_name) || ' ' || trim(last_name) AS full_name
FROM ({_latest("raw_customers", "customer_id", ["created_at"], CUSTOMER_REST, True)})
"""


def _stg_policies(raw: str) -> str:
    return f"""
SELECT policy_id, customer_id, trim(policy_number) AS policy_number,
       trim(destination_country) AS destination_country, trip_start_date, trip_end_date,
       upper(trim(coverage_type)) AS coverage_type,
       TRY_CAST(premium_amount AS DECIMAL(10, 2)) AS premium_amount,
       lower(trim(status)) AS policy_status, broker_id, created_at,
       CAST(trip_end_date - trip_start_date AS INTEGER) AS trip_duration_days
FROM ({_latest(raw, "policy_id", ["created_at"], POLICY_REST, True)})
WHERE NOT (lower(trim(status)) = 'cancelled' AND premium_amount IS NULL)
"""


def _stg_claims(raw: str) -> str:
    return f"""
SELECT claim_id, policy_id, lower(trim(claim_type)) AS claim_type,
       TRY_CAST(claim_amount AS DECIMAL(12, 2)) AS claim_amount, claim_date,
       lower(trim(status)) AS claim_status, description, processed_at, created_at,
       CASE WHEN processed_at IS NOT NULL
            THEN CAST(CAST(processed_at AS DATE) - claim_date AS INTEGER) END AS days_to_process,
       coalesce(lower(trim(status)) = 'approved', FALSE) AS is_approved
FROM ({_latest(raw, "claim_id", ["created_at"], CLAIM_REST, True)})
"""


STG_BROKERS = f"""
SELECT broker_id, broker_name, broker_company, country, policies_sold_today, total_premium_value,
       commission_rate, commission_earned, commission_percentage, report_date
FROM ({_latest(
    '''(SELECT broker_id, trim(broker_name) AS broker_name, trim(broker_company) AS broker_company,
              trim(country) AS country, policies_sold_today, total_premium_value, commission_rate,
              commission_earned,
              CAST(commission_rate * 100 AS DECIMAL(5, 2)) AS commission_percentage, report_date
       FROM raw_broker_commissions)''',
    "broker_id", ["report_date", "commission_earned"],
    ["broker_name", "broker_company", "country", "policies_sold_today", "total_premium_value",
     "commission_rate", "commission_percentage"], True)})
"""

STG_FLIGHTS = """
SELECT icao24, trim(callsign) AS callsign, trim(origin_country) AS origin_country, longitude,
       latitude, altitude, velocity, heading, on_ground, event_timestamp, ingested_at
FROM clean_flights WHERE nullif(trim(callsign), '') IS NOT NULL
"""

DIM_CUSTOMERS = f"""
SELECT {_key("customer_id")} AS customer_sk, customer_id, first_name, last_name, full_name, email,
       date_of_birth,
       CASE WHEN date_of_birth IS NOT NULL
            THEN CAST(greatest(date_diff('year', date_of_birth, CAST({AS_OF} AS DATE)), 0) AS INTEGER)
       END AS customer_age,
       country_of_residence, country_iso_code, phone, created_at
FROM stg_customers
"""

DIM_DESTINATIONS = f"""
SELECT {_key("destination_country")} AS destination_sk, destination_country,
       {CONTINENT.format("destination_country")} AS continent
FROM (SELECT DISTINCT upper(destination_country) AS destination_country FROM stg_policies)
"""

DIM_BROKERS = f"""
SELECT {_key("broker_id")} AS broker_sk, broker_id, broker_name, broker_company, country,
       policies_sold_today, total_premium_value, commission_rate, commission_percentage,
       commission_earned, report_date
FROM stg_brokers
"""

DIM_DATE = f"""
SELECT {_key("date_day")} AS date_sk, date_day, CAST(year(date_day) AS INTEGER) AS year,
       CAST(month(date_day) AS INTEGER) AS month, CAST(quarter(date_day) AS INTEGER) AS quarter,
       CAST(dayofweek(date_day) AS INTEGER) AS day_of_week,
       dayofweek(date_day) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(DATE '2023-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS DATE)
             AS date_day)
"""


def _fact_policies(policies: str) -> str:
    return f"""
SELECT p.policy_id, c.customer_sk, d.destination_sk, b.broker_sk, t.date_sk, p.customer_id,
       upper(p.destination_country) AS destination_country, p.broker_id, p.trip_start_date,
       p.trip_end_date, p.premium_amount, p.coverage_type, p.trip_duration_days, p.policy_status,
       p.created_at
FROM {policies} p
LEFT JOIN dim_customers c ON p.customer_id = c.customer_id
LEFT JOIN dim_destinations d ON upper(p.destination_country) = d.destination_country
LEFT JOIN dim_brokers b ON p.broker_id = b.broker_id
LEFT JOIN dim_date t ON p.trip_start_date = t.date_day
"""


def _fact_claims(claims: str, policies: str) -> str:
    return f"""
SELECT c.claim_id, c.policy_id, p.customer_sk, p.destination_sk, p.broker_sk, p.date_sk,
       p.destination_country, c.claim_type, c.claim_amount, c.claim_status, c.is_approved,
       c.days_to_process, c.claim_date, c.processed_at, c.created_at
FROM {claims} c LEFT JOIN {policies} p ON c.policy_id = p.policy_id
"""


def _twice(table: str, key: str) -> str:
    """First-run rows not replaced, plus the rows newer than the first run's newest."""
    newer = (
        f"SELECT * FROM {table}_full WHERE created_at > (SELECT coalesce(max(created_at), "
        f"TIMESTAMP '1900-01-01 00:00:00') FROM {table}_early)"
    )
    return (
        f"SELECT * FROM {table}_early WHERE {key} NOT IN (SELECT {key} FROM ({newer})) "
        f"UNION ALL {newer}"
    )


WHOLE_MESSAGE = "event_id % 100 <> 0 AND event_id % 101 <> 0 AND event_id % 107 <> 0"


def _short(column: str) -> str:
    return f"CASE WHEN event_id % 103 <> 0 THEN {column} END AS {column.split('.')[-1]}"


ACCEPTED = f"""
SELECT icao24, {_short("callsign")}, {_short("origin_country")}, {_short("longitude")},
       {_short("latitude")}, {_short("altitude")}, {_short("velocity")}, {_short("heading")},
       CASE WHEN event_id % 103 <> 0 THEN on_ground = 'TRUE' END AS on_ground,
       event_timestamp, {LANDING_AS_OF} AS ingested_at
FROM raw_flights WHERE {WHOLE_MESSAGE}
"""

# name -> (SQL, names it reads)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_customers": (RAW_CUSTOMERS, ()),
    "raw_policies": (RAW_POLICIES, ()),
    "raw_claims": (RAW_CLAIMS, ()),
    "raw_broker_commissions": (RAW_BROKERS, ()),
    "raw_flights": (RAW_FLIGHTS, ()),
    "clean_flights": (_clean_flights(30), ("raw_flights",)),
    "clean_flights_1h": (_clean_flights(3600), ("raw_flights",)),
    "clean_policies": (CLEAN_POLICIES, ("raw_policies",)),
    "daily_stats": (_daily_stats("clean_flights"), ("clean_flights",)),
    "landed_flights": (ACCEPTED, ("raw_flights",)),
    "landed_clean": (_clean_flights(30, "landed_flights"), ("landed_flights",)),
    "landed_stats": (_daily_stats("landed_clean"), ("landed_clean",)),
    "stg_customers": (STG_CUSTOMERS, ("raw_customers",)),
    "stg_policies": (_stg_policies("raw_policies"), ("raw_policies",)),
    "stg_claims": (_stg_claims("raw_claims"), ("raw_claims",)),
    "stg_brokers": (STG_BROKERS, ("raw_broker_commissions",)),
    "stg_flights": (STG_FLIGHTS, ("clean_flights",)),
    "dim_customers": (DIM_CUSTOMERS, ("stg_customers",)),
    "dim_destinations": (DIM_DESTINATIONS, ("stg_policies",)),
    "dim_brokers": (DIM_BROKERS, ("stg_brokers",)),
    "dim_date": (DIM_DATE, ()),
    "fact_policies": (
        _fact_policies("stg_policies"),
        ("stg_policies", "dim_customers", "dim_destinations", "dim_brokers", "dim_date"),
    ),
    "fact_claims": (_fact_claims("stg_claims", "fact_policies"), ("stg_claims", "fact_policies")),
    "raw_policies_early": (
        f"SELECT * FROM raw_policies WHERE created_at <= {CUT}", ("raw_policies",)
    ),
    "raw_claims_early": (f"SELECT * FROM raw_claims WHERE created_at <= {CUT}", ("raw_claims",)),
    "stg_policies_early": (_stg_policies("raw_policies_early"), ("raw_policies_early",)),
    "policies_early": (
        _fact_policies("stg_policies_early"),
        ("stg_policies_early", "dim_customers", "dim_destinations", "dim_brokers", "dim_date"),
    ),
    "policies_full": ("SELECT * FROM fact_policies", ("fact_policies",)),
    "policies_twice": (_twice("policies", "policy_id"), ("policies_early", "policies_full")),
    "stg_claims_early": (_stg_claims("raw_claims_early"), ("raw_claims_early",)),
    "claims_early": (
        _fact_claims("stg_claims_early", "policies_early"), ("stg_claims_early", "policies_early")
    ),
    "claims_full": (
        _fact_claims("stg_claims", "policies_twice"), ("stg_claims", "policies_twice")
    ),
    "claims_twice": (_twice("claims", "claim_id"), ("claims_early", "claims_full")),
}


def _with(select: str, *views: str) -> str:
    """``select`` over the named views, each defined once before it is read."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in VIEWS[name][1]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in views:
        visit(name)
    if not ordered:
        return select.strip()
    body = ",\n".join(f"{name} AS ({VIEWS[name][0].strip()})" for name in ordered)
    return f"WITH {body}\n{select.strip()}"


def _all(view: str) -> str:
    return _with(f"SELECT * FROM {view}", view)


def _counts(pairs: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {v}" for n, v in pairs)


def _removed(pairs: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, b AS before, a AS after, b - a AS removed FROM "
        f"(SELECT (SELECT count(*) FROM {raw}) AS b, (SELECT count(*) FROM {clean}) AS a)"
        for n, raw, clean in pairs
    )


def _check(table: str, check: str, column: str, failures: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
        f"failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status "
        f"FROM (SELECT CAST(({failures}) AS BIGINT) AS failures)"
    )


def _not_null(table: str, view: str, column: str) -> str:
    return _check(table, "not_null", column, f"SELECT count(*) FROM {view} WHERE {column} IS NULL")


def _unique(table: str, view: str, column: str) -> str:
    return _check(
        table, "unique", column,
        f"SELECT count(*) FROM (SELECT {column} FROM {view} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)",
    )


def _accepted(table: str, view: str, column: str, values: str) -> str:
    return _check(
        table, "accepted_values", column,
        f"SELECT count(*) FROM {view} WHERE {column} NOT IN ({values})",
    )


def _related(table: str, view: str, column: str, parents: str, parent: str) -> str:
    return _check(
        table, "relationships", column,
        f"SELECT count(*) FROM {view} k WHERE k.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parents} p WHERE p.{parent} = k.{column})",
    )


def _quality_checks() -> str:
    parts = []
    for table, key in (
        ("dim_customers", "customer_sk"), ("dim_destinations", "destination_sk"),
        ("dim_brokers", "broker_sk"), ("dim_date", "date_sk"), ("fact_policies", "policy_id"),
        ("fact_claims", "claim_id"),
    ):
        parts += [_not_null(table, table, key), _unique(table, table, key)]
    parts.append(
        _accepted("fact_policies", "fact_policies", "policy_status", "'active', 'expired', 'cancelled'")
    )
    parts.append(_related("fact_claims", "fact_claims", "policy_id", "fact_policies", "policy_id"))
    parts.append(
        _check("fact_claims", "expression_is_true", "claim_amount",
               "SELECT count(*) FROM fact_claims WHERE NOT (claim_amount > 0)")
    )
    return " UNION ALL ".join(parts)


def _constraints() -> str:
    filled = {
        "customers": CUSTOMER_REST[:5] + ["customer_id"],
        "policies": ["policy_id", *POLICY_REST],
        "claims": ["claim_id", "policy_id", "claim_type", "claim_amount", "claim_date", "status"],
    }
    parts = [_not_null(t, f"raw_{t}", c) for t, columns in filled.items() for c in columns]
    for table, column in (
        ("customers", "customer_id"), ("customers", "email"), ("policies", "policy_id"),
        ("policies", "policy_number"), ("claims", "claim_id"),
    ):
        parts.append(_unique(table, f"raw_{table}", column))
    parts.append(_related("policies", "raw_policies", "customer_id", "raw_customers", "customer_id"))
    parts.append(_related("claims", "raw_claims", "policy_id", "raw_policies", "policy_id"))
    for table, column, values in (
        ("policies", "coverage_type", "'medical', 'cancellation', 'baggage', 'comprehensive'"),
        ("policies", "status", "'active', 'expired', 'cancelled'"),
        ("claims", "claim_type", "'medical', 'cancellation', 'baggage', 'delay'"),
        ("claims", "status", "'pending', 'approved', 'rejected'"),
    ):
        parts.append(_accepted(table, f"raw_{table}", column, values))
    return _with(" UNION ALL ".join(parts), "raw_customers", "raw_policies", "raw_claims")


def _freshness() -> str:
    sources = (
        ("raw_customers", "raw_customers", "created_at"),
        ("raw_policies", "raw_policies", "created_at"),
        ("raw_claims", "raw_claims", "created_at"),
        ("raw_broker_commissions", "raw_broker_commissions", "report_date"),
        ("raw_flights", "raw_flights", "ingested_at"),
        ("flight_daily_stats", "daily_stats", "flight_day"),
        ("bronze_flights_clean", "clean_flights", "ingested_at"),
    )
    newest = " UNION ALL ".join(
        f"SELECT '{n}' AS source_name, max(CAST({c} AS TIMESTAMP)) AS max_loaded_at FROM {v}"
        for n, v, c in sources
    )
    age = f"date_sub('second', max_loaded_at, {LANDING_AS_OF})"
    return _with(
        f"SELECT source_name, max_loaded_at, {age} AS age_seconds, "
        f"CASE WHEN max_loaded_at IS NULL OR {age} > 48 * 3600 THEN 'error' "
        f"WHEN {age} > 24 * 3600 THEN 'warn' ELSE 'pass' END AS status FROM ({newest})",
        *[v for _, v, _ in sources],
    )


def _reconciliation() -> str:
    pairs = (
        ("customers", "raw_customers", "dim_customers"),
        ("policies", "raw_policies", "fact_policies"),
        ("claims", "raw_claims", "fact_claims"),
    )
    counts = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {s}) AS source_count, "
        f"(SELECT count(*) FROM {t}) AS destination_count"
        for n, s, t in pairs
    )
    percent = """round(CASE WHEN source_count = 0
        THEN CASE WHEN destination_count = 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END
        ELSE greatest(0.0::DOUBLE, (1 - abs(source_count - destination_count)::DOUBLE
             / source_count::DOUBLE) * 100) END, 2)"""
    return f"""
SELECT table_name, source_count, destination_count,
       destination_count - source_count AS difference,
       match_percentage, match_percentage >= 95.0 AS passed
FROM (SELECT *, {percent} AS match_percentage FROM ({counts}))
"""


GATE = (
    f"SELECT (SELECT count(*) FROM raw_policies WHERE created_at >= {EVENTS_AS_OF} - INTERVAL 24 HOUR) AS policies_count, "
    f"(SELECT count(*) FROM raw_claims WHERE created_at >= {EVENTS_AS_OF} - INTERVAL 24 HOUR) AS claims_count"
)


def _daily_states() -> str:
    """States of a run whose only possible troubles are its gate, its checks and its counts."""
    done = ("extract_sources", "load_broker_file", "clean_bronze", "build_gold")
    parts = [
        "SELECT 'check_source_activity' AS step, CASE WHEN policies_count + claims_count > 0 "
        f"THEN 'success' ELSE 'skipped' END AS state FROM ({GATE})",
        *[f"SELECT '{step}', 'success'" for step in done],
        "SELECT 'check_quality', CASE WHEN sum(failures) = 0 THEN 'success' ELSE 'failed' END "
        f"FROM ({_quality_checks()})",
        "SELECT 'reconcile', CASE WHEN bool_and(passed) THEN 'success' ELSE 'failed' END "
        f"FROM ({_reconciliation()})",
    ]
    return " UNION ALL ".join(parts)


REJECTED = """
SELECT CASE WHEN event_id % 100 = 0 THEN '{"icao24": "' || icao24
            WHEN event_id % 101 = 0 THEN '[1]'
            ELSE '{"icao24": "bad", "altitude": "high"}' END AS raw_value
FROM raw_flights WHERE event_id % 100 = 0 OR event_id % 101 = 0 OR event_id % 107 = 0
"""


def _long(expression: str) -> str:
    return f"CASE WHEN event_id % 13 <> 0 THEN {expression} END"


STATES = f"""
SELECT icao24, trim(callsign) AS callsign, origin_country,
       {_long("longitude")} AS longitude, {_long("latitude")} AS latitude,
       {_long("altitude")} AS altitude, {_long("velocity")} AS velocity, {_long("heading")} AS heading,
       event_id % 13 <> 0 AND coalesce(on_ground = 'TRUE', FALSE) AS on_ground,
       '2024-01-30T23:59:00+00:00' AS "timestamp"
FROM raw_flights WHERE event_id % 17 <> 0
"""


def _json(fields: list[tuple[str, str]]) -> str:
    """JSON object text: strings quoted, other values as their text, NULL as null."""
    parts = []
    for i, (name, value) in enumerate(fields):
        lead = "{" if i == 0 else ","
        parts.append(f"'{lead}\"{name}\":' || coalesce({value}, 'null')")
    return " || ".join(parts) + " || '}'"


def _quoted(expression: str) -> str:
    return f"'\"' || {expression} || '\"'"


STATE_MESSAGES = f"""
SELECT icao24 AS "key", {_json([
    ("icao24", _quoted("icao24")), ("callsign", _quoted("callsign")),
    ("origin_country", _quoted("origin_country")),
    *[(n, f"CAST({n} AS VARCHAR)") for n in ("longitude", "latitude", "altitude", "velocity", "heading", "on_ground")],
    ("timestamp", _quoted('"timestamp"')),
])} AS "value"
FROM ({STATES})
"""

RECENT_POLICIES = f"""
SELECT * FROM raw_policies WHERE created_at >= {EVENTS_AS_OF} - INTERVAL 1 HOUR
ORDER BY created_at DESC NULLS FIRST, policy_id LIMIT 200
"""


def _iso(column: str) -> str:
    return f"replace(strftime({column}, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '')"


POLICY_EVENTS = f"""
SELECT CAST(policy_id AS VARCHAR) AS "key", {_json([
    ("policy_id", "CAST(policy_id AS VARCHAR)"), ("customer_id", "CAST(customer_id AS VARCHAR)"),
    ("policy_number", _quoted("policy_number")),
    ("destination_country", _quoted("destination_country")),
    ("trip_start_date", _quoted("CAST(trip_start_date AS VARCHAR)")),
    ("trip_end_date", _quoted("CAST(trip_end_date AS VARCHAR)")),
    ("coverage_type", _quoted("coverage_type")), ("premium_amount", _quoted("premium_amount")),
    ("status", _quoted("status")), ("broker_id", "CAST(broker_id AS VARCHAR)"),
    ("created_at", _quoted(_iso("created_at"))),
    ("event_timestamp", "'\"2029-07-30T00:30:00+00:00\"'"),
    ("event_type", "'\"policy_purchase\"'"),
])} AS "value"
FROM ({RECENT_POLICIES}) WHERE policy_id % 3 <> 0
"""

CLOSED_WINDOWS = """
WHERE time_bucket(INTERVAL 30 SECOND, event_timestamp) + INTERVAL 30 SECOND
      <= (SELECT max(event_timestamp) - INTERVAL 1 HOUR FROM raw_flights)
"""

def _kpis(policies: str) -> str:
    return f"""
SELECT coalesce(CAST(sum(CASE WHEN year(trip_start_date) = 2025 THEN premium_amount END) AS DOUBLE), 0)
           AS total_revenue_this_year,
       count(*) AS total_policies,
       CASE WHEN count(*) > 0
            THEN coalesce(CAST(sum(CASE WHEN year(trip_start_date) = 2025 THEN premium_amount END) AS DOUBLE), 0)
                 / count(*) ELSE 0.0 END AS average_premium
FROM {policies}
"""


def _summed_reports(policies: str, claims: str) -> dict[str, str]:
    """Reports that are sums over the facts, for any state of these."""
    return {
        "revenue_by_month": _with(
            "SELECT CAST(date_trunc('month', trip_start_date) AS DATE) AS month, "
            "CAST(sum(premium_amount) AS DECIMAL(20, 2)) AS total_premium, count(*) AS policy_count "
            f"FROM {policies} GROUP BY 1", policies,
        ),
        "premium_by_destination": _with(
            f"SELECT d.destination_country, sum(f.premium_amount) AS total_premium FROM {policies} f "
            "LEFT JOIN dim_destinations d ON f.destination_sk = d.destination_sk GROUP BY 1", policies,
        ),
        "revenue_kpis": _with(_kpis(policies), policies),
        "claim_kpis": _with(
            "SELECT count(*) AS total_claims, CAST(sum(CASE WHEN is_approved THEN 1 ELSE 0 END) AS BIGINT) "
            "AS approved_claims, round(CAST(sum(CASE WHEN is_approved THEN 1 ELSE 0 END) AS DOUBLE) "
            f"/ nullif(count(*), 0) * 100, 2) AS approval_rate FROM {claims}", claims,
        ),
        "claims_by_type": _with(
            f"SELECT claim_type, count(*) AS claim_count FROM {claims} GROUP BY 1", claims
        ),
        "average_claim_by_destination": _with(
            "SELECT d.destination_country, CAST(CAST(sum(f.claim_amount) AS DOUBLE) / count(f.claim_amount) "
            f"AS DECIMAL(16, 6)) AS avg_claim_amount FROM {claims} f LEFT JOIN dim_destinations d "
            "ON f.destination_sk = d.destination_sk GROUP BY 1", claims,
        ),
        "approval_by_type": _with(
            f"SELECT claim_type, claim_status, count(*) AS claim_count FROM {claims} "
            "WHERE claim_status IN ('approved', 'rejected') GROUP BY 1, 2", claims,
        ),
    }


LEADERBOARD = """
SELECT broker_id, broker_name, broker_company, country, policies_sold_today, total_premium_value,
       commission_rate, commission_percentage, commission_earned, report_date FROM dim_brokers
"""

BY_COUNTRY = """
SELECT origin_country, count(*) AS flight_count, round(avg(altitude), 9) AS avg_altitude,
       round(avg(velocity), 9) AS avg_velocity,
       CAST(sum(CASE WHEN on_ground THEN 1 ELSE 0 END) AS BIGINT) AS ground_count
FROM stg_flights GROUP BY origin_country
"""

CHANGED_COPY = """, ours AS (
    SELECT policy_id, customer_id, destination_country, premium_amount, policy_status FROM fact_policies
), theirs AS (
    SELECT CASE WHEN policy_id % 1009 = 7 THEN policy_id + 100000000 ELSE policy_id END AS policy_id, customer_id,
           destination_country, CASE WHEN policy_id % 997 = 5 THEN premium_amount + 1 ELSE premium_amount END AS premium_amount,
           policy_status
    FROM ours
), differing AS (
    SELECT coalesce(s.policy_id, t.policy_id) AS policy_id,
           CASE WHEN t.policy_id IS NULL THEN 'missing' WHEN s.policy_id IS NULL THEN 'unexpected' ELSE 'changed' END AS status,
           CAST(s.policy_id IS NOT NULL AS BIGINT) AS source_rows, CAST(t.policy_id IS NOT NULL AS BIGINT) AS target_rows,
           CASE WHEN s.policy_id IS NOT NULL AND t.policy_id IS NOT NULL THEN 'premium_amount' ELSE '' END AS differing_columns
    FROM ours s FULL JOIN theirs t ON s.policy_id = t.policy_id
    WHERE s.policy_id IS NULL OR t.policy_id IS NULL OR s.premium_amount IS DISTINCT FROM t.premium_amount
)"""

LAG = """
SELECT partition, CAST(greatest(high - CASE WHEN committed < 0 THEN 0 ELSE committed END, 0) AS BIGINT) AS lag
FROM (SELECT partition, high, CASE partition WHEN 3 THEN -1 WHEN 5 THEN high + 10 ELSE done END AS committed
      FROM (SELECT CAST(user_id % 8 AS INTEGER) AS partition, count(*) AS high,
                   count(*) FILTER (event_id % 5 <> 0) AS done FROM events GROUP BY 1))
"""

ORDER_TIME = "(o_orderdate + to_seconds(o_orderkey % 86400))"

ORACLE: dict[str, str] = {
    "clean_flights_30s": _all("clean_flights"),
    "clean_flights_1h": _all("clean_flights_1h"),
    "clean_policies": _all("clean_policies"),
    "flight_daily_stats": _all("daily_stats"),
    "flight_daily_report": _with("SELECT * FROM daily_stats ORDER BY flight_day, origin_country", "daily_stats"),
    "cleaning_removed_rows": _with(
        _removed([("RAW_FLIGHTS", "raw_flights", "clean_flights"),
                  ("RAW_POLICIES", "raw_policies", "clean_policies")]),
        "clean_flights", "clean_policies",
    ),
    "trimmed_claims": _with(
        "SELECT * REPLACE (trim(claim_type) AS claim_type, trim(claim_amount) AS claim_amount, "
        "trim(status) AS status, trim(description) AS description) FROM raw_claims", "raw_claims",
    ),
    "event_buckets": _with(
        "SELECT time_bucket(INTERVAL 30 SECOND, event_timestamp) AS bucket_start, "
        "count(*) AS event_count FROM raw_flights GROUP BY 1", "raw_flights",
    ),
    "bronze_row_counts": _with(
        _counts([
            ("RAW_CUSTOMERS", "raw_customers"), ("RAW_POLICIES", "raw_policies"),
            ("RAW_CLAIMS", "raw_claims"), ("RAW_BROKER_COMMISSIONS", "raw_broker_commissions"),
            ("RAW_FLIGHTS", "raw_flights"), ("BRONZE_FLIGHTS_CLEAN", "clean_flights"),
            ("BRONZE_POLICIES_CLEAN", "clean_policies"), ("FLIGHT_DAILY_STATS", "daily_stats"),
        ]),
        "raw_customers", "raw_claims", "raw_broker_commissions", "clean_policies", "daily_stats",
    ),
    "incremental_extract": _with(f"SELECT * FROM raw_policies WHERE created_at > {CUT}", "raw_policies"),
    "extract_run": _with(
        " UNION ALL ".join(
            f"SELECT '{n}' AS source_table, count(*) AS extracted, count(*) AS loaded "
            f"FROM raw_{n} WHERE created_at > {CUT}" for n in ("customers", "policies", "claims")
        ),
        "raw_customers", "raw_policies", "raw_claims",
    ),
    "appended_customers": _with(
        "SELECT " + ", ".join(f'{c} AS "{c.upper()}"' for c in ["customer_id", *CUSTOMER_REST, "created_at"])
        + " FROM raw_customers", "raw_customers",
    ),
    "newest_broker_drop": _with(
        "SELECT * FROM raw_broker_commissions WHERE report_date = DATE '2024-01-02'",
        "raw_broker_commissions",
    ),
    "flight_messages_accepted": _with(ACCEPTED, "raw_flights"),
    "flight_messages_rejected": _with(REJECTED, "raw_flights"),
    "flight_states": _with(STATES, "raw_flights"),
    "flight_state_messages": _with(STATE_MESSAGES, "raw_flights"),
    "recent_policies": _with(RECENT_POLICIES, "raw_policies"),
    "policy_events": _with(POLICY_EVENTS, "raw_policies"),
    "published_policies": _with(
        f"""SELECT CAST(policy_id AS VARCHAR) AS "key", count(*) AS messages FROM (
            SELECT policy_id FROM raw_policies WHERE {PUBLISHED} AND {PUBLISHED_FIRST}
            UNION ALL SELECT policy_id FROM raw_policies WHERE {PUBLISHED} AND policy_id NOT IN (
                SELECT policy_id FROM raw_policies WHERE {PUBLISHED} AND {PUBLISHED_FIRST})
            UNION ALL SELECT policy_id FROM raw_policies WHERE {PUBLISHED}) GROUP BY policy_id""", "raw_policies",
    ),
    "refreshed_flights": _with(
        f"""SELECT * REPLACE (CASE WHEN CAST(event_timestamp AS DATE) IN (
            SELECT CAST(event_timestamp AS DATE) FROM raw_flights WHERE ingested_at >= TIMESTAMP '2024-01-15 11:00:00')
        THEN {LANDING_AS_OF} ELSE TIMESTAMP '2024-01-15 12:00:00' END AS ingested_at) FROM clean_flights""",
        "clean_flights", "raw_flights",
    ),
    "fact_policies_new_column": _with(
        f"SELECT *, CASE WHEN created_at > {CUT} THEN CASE WHEN policy_id % 2 = 0 THEN 'web' ELSE 'agent' END END "
        "AS sales_channel FROM policies_twice", "policies_twice",
    ),
    "stg_customers": _all("stg_customers"),
    "stg_policies": _all("stg_policies"),
    "stg_claims": _all("stg_claims"),
    "silver_customers_incremental": _all("stg_customers"),
    "silver_policies_incremental": _all("stg_policies"),
    "silver_claims_incremental": _all("stg_claims"),
    "stg_brokers": _all("stg_brokers"),
    "stg_flights": _all("stg_flights"),
    "stg_flight_stats": _with(
        "SELECT flight_day AS stat_date, * EXCLUDE (flight_day) FROM daily_stats", "daily_stats"
    ),
    "dim_customers": _all("dim_customers"),
    "dim_destinations": _all("dim_destinations"),
    "dim_brokers": _all("dim_brokers"),
    "dim_date": _with(
        "SELECT d.*, (SELECT count(*) FROM stg_policies p WHERE p.trip_start_date = d.date_day) "
        "AS policies_starting FROM dim_date d", "dim_date", "stg_policies",
    ),
    "fact_policies": _all("fact_policies"),
    "fact_policies_deltas": _all("policies_twice"),
    "fact_policies_compacted": _all("policies_twice"),
    "fact_claims": _all("fact_claims"),
    "fact_policies_incremental": _all("policies_twice"),
    "fact_claims_incremental": _all("claims_twice"),
    "fact_claims_colocated": _all("claims_full"),
    **_summed_reports("fact_policies", "fact_claims"),
    "recent_claims": _with(
        "SELECT claim_date, destination_country, claim_type, claim_amount, claim_status AS status "
        "FROM fact_claims ORDER BY claim_date DESC NULLS FIRST, claim_id LIMIT 20", "fact_claims",
    ),
    "broker_leaderboard": _with(LEADERBOARD, "dim_brokers"),
    "broker_leaderboard_country": _with(LEADERBOARD + " WHERE country = 'NATION_7'", "dim_brokers"),
    "top_brokers": _with(
        "SELECT broker_id, broker_name, commission_earned FROM dim_brokers "
        "ORDER BY commission_earned DESC NULLS FIRST, broker_id LIMIT 15", "dim_brokers",
    ),
    "broker_points": _with(
        "SELECT broker_name, country, policies_sold_today, commission_earned FROM dim_brokers", "dim_brokers"
    ),
    "broker_countries": _with(
        "SELECT DISTINCT country FROM dim_brokers WHERE country IS NOT NULL", "dim_brokers"
    ),
    "flights_by_country": _with(BY_COUNTRY, "stg_flights"),
    "total_flights": _with("SELECT count(*) AS total_flights FROM stg_flights", "stg_flights"),
    "top_countries": _with(
        "SELECT origin_country, count(*) AS flight_count FROM stg_flights GROUP BY 1 "
        "ORDER BY 2 DESC, 1 LIMIT 20", "stg_flights",
    ),
    "latest_flights": _with(
        "SELECT icao24, callsign, origin_country, altitude, velocity, on_ground, ingested_at "
        "FROM raw_flights ORDER BY ingested_at DESC NULLS FIRST, event_timestamp DESC NULLS LAST, "
        "icao24 LIMIT 50", "raw_flights",
    ),
    "ad_hoc_query": _with(
        "SELECT coverage_type, policy_status, count(*) AS policy_count, "
        "count(date_sk) AS dated_policies FROM fact_policies GROUP BY 1, 2", "fact_policies",
    ),
    "ad_hoc_query_reused": _with(
        "SELECT d.destination_country, count(*) AS policy_count, sum(f.premium_amount) AS total_premium FROM fact_policies f "
        "LEFT JOIN dim_destinations d ON f.destination_sk = d.destination_sk GROUP BY 1", "fact_policies",
    ),
    "quality_report": _with(_quality_checks(), "fact_policies", "fact_claims"),
    "quality_report_incremental": _with(_quality_checks(), "fact_policies", "fact_claims"),
    "source_constraints": _constraints(),
    "non_positive_claims": _with(
        "SELECT claim_id, claim_amount FROM fact_claims WHERE claim_amount <= 0", "fact_claims"
    ),
    "orphan_claims": _with(
        "SELECT c.policy_id, count(*) AS row_count FROM fact_claims c WHERE c.policy_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM fact_policies p WHERE p.policy_id = c.policy_id) GROUP BY 1",
        "fact_claims",
    ),
    "freshness_report": _freshness(),
    "reconciliation": _with(
        _reconciliation(), "dim_customers", "fact_policies", "fact_claims"
    ),
    "reconciliation_verdict": _with(
        f"SELECT bool_and(passed) AS all_passed FROM ({_reconciliation()})",
        "dim_customers", "fact_policies", "fact_claims",
    ),
    "freshness_gate": _with(
        f"SELECT *, policies_count > 0 OR claims_count > 0 AS should_run FROM ({GATE})",
        "raw_policies", "raw_claims",
    ),
    "partition_lag": LAG.strip(),
    "stream_lag": "SELECT total_lag, CASE WHEN total_lag > 1000 THEN 'high' ELSE 'healthy' END AS status "
                  f"FROM (SELECT CAST(coalesce(sum(lag), 0) AS BIGINT) AS total_lag FROM ({LAG.strip()}))",
    "landing_freshness": _with(
        "SELECT recent_rows, CASE WHEN recent_rows = 0 THEN 'warning' ELSE 'healthy' END AS status "
        f"FROM (SELECT count(*) AS recent_rows FROM raw_flights WHERE ingested_at >= {LANDING_AS_OF} "
        "- INTERVAL 30 MINUTE)", "raw_flights",
    ),
    "calendar_parts": _with(
        "SELECT policy_id, created_at, trip_start_date, CAST(created_at AS DATE) AS created_day, "
        "CAST(date_trunc('month', trip_start_date) AS DATE) AS month_start, "
        "CAST(year(trip_start_date) AS INTEGER) AS year, CAST(month(trip_start_date) AS INTEGER) AS month, "
        "CAST(quarter(trip_start_date) AS INTEGER) AS quarter, "
        "CAST(dayofweek(trip_start_date) AS INTEGER) AS day_of_week, "
        "dayofweek(trip_start_date) IN (0, 6) AS is_weekend, "
        "CAST(trip_end_date - trip_start_date AS INTEGER) AS trip_days FROM raw_policies", "raw_policies",
    ),
    "commissions": _with(
        "SELECT broker_id, report_date, CAST(total_premium_value * CAST(commission_rate AS DECIMAL(5, 4)) "
        "AS DECIMAL(12, 2)) AS commission, CAST(commission_rate * 100 AS DECIMAL(5, 2)) "
        "AS commission_percentage FROM raw_broker_commissions", "raw_broker_commissions",
    ),
    "parsed_timestamps": (
        f"SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN date_trunc('day', {ORDER_TIME}) "
        f"WHEN 2 THEN NULL ELSE {ORDER_TIME} END AS parsed FROM orders"
    ),
    "daily_run": _with(_daily_states(), "raw_customers", "fact_policies", "fact_claims"),
    "daily_run_summary": _with(
        "SELECT count(*) FILTER (state = 'failed') AS failed_steps, "
        "count(*) FILTER (state = 'upstream_failed') AS upstream_failed_steps, "
        "count(*) FILTER (state IN ('failed', 'upstream_failed')) = 0 AS succeeded "
        f"FROM ({_daily_states()})", "raw_customers", "fact_policies", "fact_claims",
    ),
    "daily_run_policies": _all("fact_policies"),
    "daily_run_flight_stats": _all("landed_stats"),
    "daily_run_quality": _with(_quality_checks(), "fact_policies", "fact_claims"),
    "daily_run_flights": _with("SELECT * EXCLUDE (ingested_at) FROM landed_clean", "landed_clean"),
    "stream_flight_ingest": _with(ACCEPTED, "raw_flights"),
    "stream_flight_restart": _with(ACCEPTED, "raw_flights"),
    "stream_flight_rejects": _with(REJECTED, "raw_flights"),
    "stream_flight_dedup": _with(
        "SELECT icao24, callsign, origin_country, longitude, latitude, altitude, velocity, heading, "
        "coalesce(lower(on_ground) IN ('true', '1', 'yes'), FALSE) AS on_ground, event_timestamp, "
        "ingested_at FROM ("
        + _latest(
            "raw_flights", "icao24, time_bucket(INTERVAL 30 SECOND, event_timestamp)", ["event_timestamp"],
            [c for c in FLIGHT_COLUMNS if c not in ("icao24", "event_timestamp")], False,
        )
        + f") {CLOSED_WINDOWS} AND latitude IS NOT NULL AND longitude IS NOT NULL", "raw_flights",
    ),
    "stream_flight_states": _with(STATE_MESSAGES, "raw_flights"),
    "stream_policy_events": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS \"key\", "
        "' POL-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || ' ' AS policy_number, "
        "CAST(CAST(o_orderdate AS DATE) + 10227 AS VARCHAR) AS trip_start_date, "
        f"{_iso('(o_orderdate + to_days(10227) + to_seconds(o_orderkey % 86400))')} AS created_at, "
        "'policy_purchase' AS event_type FROM orders"
    ),
    "differing_policy_ranges": _with(
        f"{CHANGED_COPY} SELECT CAST(floor(policy_id / 100) * 100 AS BIGINT) AS range_start, "
        "CAST(floor(policy_id / 100) * 100 + 100 AS BIGINT) AS range_end, count(*) FILTER (side = 's') AS source_rows, "
        "count(*) FILTER (side = 't') AS target_rows FROM (SELECT policy_id, 's' AS side FROM ours "
        "UNION ALL SELECT policy_id, 't' FROM theirs) WHERE floor(policy_id / 100) IN "
        "(SELECT floor(policy_id / 100) FROM differing) GROUP BY 1, 2", "fact_policies",
    ),
    "differing_policies": _with(f"{CHANGED_COPY} SELECT * FROM differing", "fact_policies"),
    # A claim that came before its policy keeps NULL keys.
    **{f"{name}_maintained": sql for name, sql in _summed_reports("policies_twice", "claims_twice").items()},
}
