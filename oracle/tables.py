"""Common table expressions the oracle statements are assembled from.

``source1_*`` / ``source2_*`` are the two source snapshots (FIXTURES.md), ``wh1_*``
/ ``wh2_*`` all versions in the warehouse after each batch, ``star_*`` the star
after batch 2. ``with_tables`` puts those a statement mentions in front of it.
"""

from __future__ import annotations

import re

BUCKETS = 1 << 20
NEW_ID = 10**15
TS1 = "TIMESTAMP '2024-06-01 00:00:00'"
TS2 = "TIMESTAMP '2024-06-02 00:00:00'"

CTES: dict[str, str] = {}

# ---- batch 1 sources -----------------------------------------------------------

CTES["source1_airports"] = """
SELECT n_nationkey::BIGINT AS airport_id, 'N' || n_nationkey AS code, n_name AS name,
       n_name AS city, r_name AS country
FROM nation JOIN region ON n_regionkey = r_regionkey"""
CTES["source1_pilots"] = """
SELECT s_suppkey AS pilot_id, s_name AS name, 'L' || s_suppkey AS license_number FROM supplier"""
CTES["source1_cabin_crew"] = """
SELECT s_suppkey AS cabin_crew_id, s_name AS name, 'E' || s_suppkey AS employee_id
FROM supplier"""
CTES["source1_customers"] = """
SELECT c_custkey AS customer_id, c_name AS full_name, c_name || '@example.org' AS email,
       CASE WHEN c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS frequent_flyer
FROM customer"""
CTES["source1_airplanes"] = """
SELECT p_partkey AS airplane_id, p_type AS model, 'REG-' || p_partkey AS registration_number,
       p_retailprice / 100 AS fuel_consumption_per_hour, p_size AS maintenance_days
FROM part"""
CTES["source1_flights"] = """
SELECT o_orderkey AS flight_id, 'FL' || lpad(o_orderkey::VARCHAR, 7, '0') AS flight_number,
       o_orderkey % 25 AS departure_airport_id,
       (o_orderkey + 1 + o_custkey % 24) % 25 AS arrival_airport_id,
       o_orderdate + to_minutes(o_orderkey % 24 * 60 + delay) AS departure_time,
       CASE WHEN o_orderstatus <> 'P'
            THEN o_orderdate + to_minutes(o_orderkey % 24 * 60 + delay + 210) END AS arrival_time,
       delay::INTEGER AS delay_minutes,
       CASE o_orderstatus WHEN 'F' THEN 'scheduled' WHEN 'O' THEN 'delayed'
            ELSE 'cancelled' END AS status,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % (SELECT max(s_suppkey) + 1 FROM supplier) END AS pilot_id,
       CASE WHEN o_orderstatus <> 'P' THEN (o_orderkey + 1 + o_custkey % 9)
            % (SELECT max(s_suppkey) + 1 FROM supplier) END AS copilot_id,
       o_orderkey % (SELECT max(p_partkey) + 1 FROM part) AS airplane_id,
       o_orderstatus <> 'P' AND o_orderkey % 10 = 0 AS is_ferry_flight,
       3.5::DOUBLE AS estimated_flight_hours
FROM (SELECT *, CASE WHEN o_orderstatus = 'O' THEN 15 + o_orderkey % 106 ELSE 0 END AS delay
      FROM orders)"""
CTES["source1_flight_bookings"] = """
SELECT l_orderkey * 10 + l_linenumber AS flight_booking_id, l_orderkey AS flight_id,
       min(l_partkey) % (SELECT max(c_custkey) + 1 FROM customer) AS customer_id, l_linenumber::VARCHAR AS seat_number
FROM lineitem GROUP BY l_orderkey, l_linenumber"""
CTES["source1_flight_cabin_crew"] = """
SELECT DISTINCT l_orderkey * 10000 + l_suppkey AS flight_cabin_crew_id,
       l_orderkey AS flight_id, l_suppkey AS cabin_crew_id
FROM lineitem"""
CTES["source1_airline_reviews"] = """
SELECT event_id % (SELECT max(o_orderkey) + 1 FROM orders) AS flight_id, user_id AS customer_id, event_type AS seat_class,
       props AS content, value AS rating, value > 100 AS recommended,
       (event_id % 6)::INTEGER AS seat_comfort, ((event_id + 1) % 6)::INTEGER
         AS cabin_staff_service,
       ((event_id + 2) % 6)::INTEGER AS food_and_beverages,
       ((event_id + 3) % 6)::INTEGER AS inflight_entertainment,
       ((event_id + 4) % 6)::INTEGER AS value_for_money, ts AS date_published
FROM events"""

# ---- batch 2 sources -----------------------------------------------------------

for _same in ("pilots", "cabin_crew", "airplanes", "flight_cabin_crew"):
    CTES[f"source2_{_same}"] = f"SELECT * FROM source1_{_same}"
CTES["source2_airports"] = """
SELECT * REPLACE (CASE WHEN airport_id % 5 = 0 THEN name || ' Intl' ELSE name END AS name)
FROM source1_airports"""
CTES["source2_customers"] = f"""
SELECT * REPLACE (CASE WHEN customer_id % 7 = 0 THEN 'new.' || email ELSE email END AS email)
FROM source1_customers WHERE customer_id % 11 <> 0
UNION ALL
SELECT * REPLACE (customer_id + {NEW_ID} AS customer_id)
FROM source1_customers WHERE customer_id % 13 = 0"""
CTES["source2_flights"] = f"""
SELECT * REPLACE (
  delay_minutes + CASE WHEN flight_id % 7 = 0 THEN 10 ELSE 0 END AS delay_minutes,
  departure_time + to_minutes(CASE WHEN flight_id % 7 = 0 THEN 10 ELSE 0 END) AS departure_time,
  CASE WHEN flight_id % 17 <> 0 THEN
    arrival_time + to_minutes(CASE WHEN flight_id % 7 = 0 THEN 10 ELSE 0 END) END AS arrival_time,
  CASE WHEN flight_id % 17 = 0 THEN 'cancelled' ELSE status END AS status,
  CASE WHEN flight_id % 17 <> 0 THEN pilot_id END AS pilot_id,
  CASE WHEN flight_id % 17 <> 0 THEN copilot_id END AS copilot_id,
  CASE WHEN flight_id % 19 = 0 THEN (airplane_id + 1) % (SELECT max(p_partkey) + 1 FROM part) ELSE airplane_id END AS airplane_id)
FROM source1_flights
UNION ALL
SELECT * REPLACE (flight_id + {NEW_ID} AS flight_id)
FROM source1_flights WHERE flight_id % 101 = 0"""
CTES["source2_flight_bookings"] = f"""
SELECT * REPLACE (
  CASE WHEN flight_booking_id % 7 = 0 THEN seat_number || 'A' ELSE seat_number END AS seat_number,
  CASE WHEN flight_booking_id % 5 = 0 THEN (customer_id + 1) % (SELECT max(c_custkey) + 1 FROM customer) ELSE customer_id END
    AS customer_id)
FROM source1_flight_bookings
UNION ALL
SELECT * REPLACE (flight_booking_id + {10 * NEW_ID} AS flight_booking_id,
                  flight_id + {NEW_ID} AS flight_id)
FROM source1_flight_bookings WHERE flight_id % 101 = 0"""
CTES["source2_airline_reviews"] = """
SELECT * REPLACE (
  rating + CASE WHEN customer_id % 7 = 0 THEN 1.0 ELSE 0.0 END AS rating,
  CASE WHEN customer_id % 19 <> 0 THEN content END AS content)
FROM source1_airline_reviews
UNION ALL
SELECT * REPLACE (date_published + INTERVAL 1 DAY AS date_published)
FROM source1_airline_reviews WHERE customer_id % 13 = 0"""

# ---- warehouse -----------------------------------------------------------------

# table: (surrogate key, natural key, columns compared, source, references), where a
# reference is (referring column, table, its natural key, its surrogate key, result).
AIRPORT, PILOT = ("airports", "airport_id", "airport_sk"), ("pilots", "pilot_id", "pilot_sk")
FLIGHT = ("flight_id", "flights", "flight_id", "flight_sk", "flight_sk")
CUSTOMER = ("customer_id", "customers", "customer_id", "customer_sk", "customer_sk")
TABLES: dict[str, tuple[str, list[str], list[str], int, list[tuple[str, ...]]]] = {
    "pilots": ("pilot_sk", ["pilot_id"], ["name", "license_number"], 1, []),
    "cabin_crew": ("cabin_crew_sk", ["cabin_crew_id"], ["name", "employee_id"], 1, []),
    "customers": (
        "customer_sk", ["customer_id"], ["full_name", "email", "frequent_flyer"], 1, []),
    "airports": ("airport_sk", ["airport_id"], ["code", "name", "city", "country"], 1, []),
    "airplanes": (
        "airplane_sk", ["airplane_id"],
        ["model", "registration_number", "fuel_consumption_per_hour", "maintenance_days"], 1, []),
    "flights": (
        "flight_sk", ["flight_id"],
        ["flight_number", "departure_airport_id", "arrival_airport_id", "departure_time",
         "arrival_time", "delay_minutes", "status", "pilot_id", "copilot_id",
         "is_ferry_flight", "estimated_flight_hours"], 1,
        [("departure_airport_id", *AIRPORT, "departure_airport_sk"),
         ("arrival_airport_id", *AIRPORT, "arrival_airport_sk"),
         ("pilot_id", *PILOT, "pilot_sk"), ("copilot_id", *PILOT, "copilot_sk"),
         ("airplane_id", "airplanes", "airplane_id", "airplane_sk", "airplane_sk")]),
    "flight_cabin_crew": (
        "flight_cabin_crew_sk", ["flight_cabin_crew_id"], ["flight_id", "cabin_crew_id"], 1,
        [("cabin_crew_id", "cabin_crew", "cabin_crew_id", "cabin_crew_sk", "cabin_crew_sk"),
         FLIGHT]),
    "flight_bookings": (
        "flight_booking_sk", ["flight_booking_id"], ["seat_number"], 1, [FLIGHT, CUSTOMER]),
    "airline_reviews": (
        "airline_review_sk", ["flight_id", "customer_id", "date_published"],
        ["seat_class", "content", "rating", "recommended", "seat_comfort",
         "cabin_staff_service", "food_and_beverages", "inflight_entertainment",
         "value_for_money"], 2, [FLIGHT, CUSTOMER]),
}


def changes(name: str, null_safe: bool = False, strict: tuple[str, ...] = ()) -> str:
    """Source rows of batch 2 that are new or differ, with the version they close."""
    sk, key, compared, _, _ = TABLES[name]
    same = " AND ".join(f"w.{c} = s.{c}" for c in key)
    test = "IS DISTINCT FROM" if null_safe else "<>"
    differ = " OR ".join(f"w.{c} {test} s.{c}" for c in [*compared, *strict])
    return f"""
SELECT s.*, w.{sk} AS closes FROM source2_{name} s
LEFT JOIN (SELECT * FROM wh1_{name} WHERE is_current) w ON {same}
WHERE w.{sk} IS NULL OR {differ}"""


def opened(name: str, batch: int, rows: str, base: str) -> str:
    """New versions of resolvable rows."""
    sk, key, _, source, refs = TABLES[name]
    text = " || '|' || ".join(f"s.{c}::VARCHAR" for c in key)
    order = ", ".join(f"s.{c}" for c in key)
    joins = "".join(
        f"\nJOIN (SELECT {natural}, {ref_sk} FROM wh{batch}_{table} QUALIFY row_number() OVER"
        f" (PARTITION BY {natural} ORDER BY start_date DESC, {ref_sk} DESC) = 1) r{i}"
        f" ON s.{column} = r{i}.{natural}"
        for i, (column, table, natural, ref_sk, _) in enumerate(refs)
    )
    found = "".join(f", r{i}.{ref[3]} AS {ref[4]}" for i, ref in enumerate(refs))
    bucket = f"('0x' || substr(md5({text}), 1, 5))::BIGINT"
    return f"""
SELECT {base} + (row_number() OVER (PARTITION BY {bucket} ORDER BY {order}) - 1) * {BUCKETS}
       + {bucket} + 1 AS {sk}, s.*{found},
       {TS1 if batch == 1 else TS2} AS start_date, {source}::INTEGER AS source_id,
       {batch}::INTEGER AS insert_id, 0::INTEGER AS update_id, TRUE AS is_current
FROM ({rows}) s{joins}"""


def merged(name: str, changed: str, gone: str = "") -> str:
    """All versions after batch 2, given the changed rows."""
    sk = TABLES[name][0]
    new = opened(
        name, 2, f"SELECT * EXCLUDE closes FROM {changed}",
        f"(SELECT max({sk}) FROM wh1_{name})")
    closes = f"SELECT closes FROM {changed} WHERE closes IS NOT NULL{gone}"
    return f"""
SELECT w.* REPLACE (
  CASE WHEN c.closes IS NULL THEN w.update_id ELSE 2 END::INTEGER AS update_id,
  c.closes IS NULL AS is_current)
FROM wh1_{name} w LEFT JOIN ({closes}) c ON c.closes = w.{sk}
UNION ALL BY NAME ({new})"""


for _name in TABLES:
    CTES[f"wh1_{_name}"] = opened(_name, 1, f"SELECT * FROM source1_{_name}", "0")
    CTES[f"changes_{_name}"] = changes(_name)
    CTES[f"wh2_{_name}"] = merged(_name, f"changes_{_name}")

# ---- star ----------------------------------------------------------------------

CTES["calendar"] = """
SELECT row_number() OVER (ORDER BY d)::INTEGER AS date_sk, d AS date,
       day(d)::INTEGER AS day, month(d)::INTEGER AS month, year(d)::INTEGER AS year,
       rpad(dayname(d), 9, ' ') AS weekday
FROM (SELECT unnest(generate_series(TIMESTAMP '1970-01-01', TIMESTAMP '2099-12-31',
                                    INTERVAL 1 DAY)) AS d)"""


def star(prefix: str, batch: int, everything: bool = False) -> None:
    """CTEs of a star: current versions plus expired ones still referred to."""

    def keep(refs: str) -> str:
        return "TRUE" if everything else f"is_current OR {refs}"

    live = "TRUE" if everything else "is_current"
    wh = f"wh{batch}_"
    CTES[f"{prefix}dim_flight"] = f"""
SELECT flight_sk, flight_number, departure_airport_sk, arrival_airport_sk,
       departure_time AS departure_datetime, arrival_time AS arrival_datetime, airplane_sk,
       pilot_sk, copilot_sk, status, is_ferry_flight
FROM {wh}flights
WHERE {keep(f'''flight_sk IN (SELECT flight_sk FROM {wh}flight_bookings WHERE is_current
  UNION SELECT flight_sk FROM {wh}airline_reviews WHERE is_current)''')}"""
    CTES[f"{prefix}dim_customer"] = f"""
SELECT customer_sk, full_name, email, frequent_flyer FROM {wh}customers
WHERE {keep(f'''customer_sk IN (SELECT customer_sk FROM {wh}flight_bookings WHERE is_current
  UNION SELECT customer_sk FROM {wh}airline_reviews WHERE is_current)''')}"""
    CTES[f"{prefix}dim_airport"] = f"""
SELECT airport_sk, code, name, city, country FROM {wh}airports
WHERE {keep(f'''airport_sk IN (SELECT departure_airport_sk FROM {prefix}dim_flight
  UNION SELECT arrival_airport_sk FROM {prefix}dim_flight)''')}"""
    CTES[f"{prefix}dim_airplane"] = f"""
SELECT airplane_sk, model, registration_number, fuel_consumption_per_hour, maintenance_days
FROM {wh}airplanes
WHERE {keep(f'airplane_sk IN (SELECT airplane_sk FROM {prefix}dim_flight)')}"""
    CTES[f"{prefix}dim_pilot"] = f"""
SELECT pilot_sk, name, license_number FROM {wh}pilots
WHERE {keep(f'''pilot_sk IN (SELECT pilot_sk FROM {prefix}dim_flight
  UNION SELECT copilot_sk FROM {prefix}dim_flight)''')}"""
    CTES[f"{prefix}fact_flight"] = f"""
SELECT flight_sk, dep.date_sk AS departure_date_sk, arr.date_sk AS arrival_date_sk,
       delay_minutes, estimated_flight_hours, is_ferry_flight
FROM {wh}flights
JOIN calendar dep ON departure_time::DATE = dep.date
JOIN calendar arr ON arrival_time::DATE = arr.date
WHERE {live}"""
    CTES[f"{prefix}fact_booking"] = f"""
SELECT flight_booking_sk, flight_sk, customer_sk, seat_number
FROM {wh}flight_bookings WHERE {live}"""
    CTES[f"{prefix}fact_review"] = f"""
SELECT airline_review_sk, r.flight_sk, r.customer_sk, seat_class, rating, recommended,
       seat_comfort, cabin_staff_service, food_and_beverages, inflight_entertainment,
       value_for_money, date_sk AS date_published_sk
FROM {wh}airline_reviews r
JOIN {prefix}dim_flight USING (flight_sk)
JOIN {prefix}dim_customer USING (customer_sk)
JOIN calendar ON date_published::DATE = calendar.date
WHERE {live}"""


star("star1_", 1)
star("star_", 2)
star("starall_", 2, everything=True)

STAR_KEYS = {
    "dim_airport": "airport_sk", "dim_airplane": "airplane_sk", "dim_pilot": "pilot_sk",
    "dim_customer": "customer_sk", "dim_flight": "flight_sk", "fact_flight": "flight_sk",
    "fact_booking": "flight_booking_sk", "fact_review": "airline_review_sk",
}


def with_tables(statement: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a statement with the CTEs it needs, directly or not."""
    known = CTES | (extra or {})
    ordered: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\w+", text):
            if word in known and word not in ordered:
                visit(known[word])
                ordered.append(word)

    visit(statement)
    parts = [f"{name} AS MATERIALIZED ({known[name]})" for name in ordered]
    return f"WITH {', '.join(parts)}\n{statement}" if parts else statement
