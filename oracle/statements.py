"""The oracle statement of each registered query."""

from __future__ import annotations

from oracle.tables import (
    CTES, STAR_KEYS, TABLES, TS1, changes, merged, opened, with_tables,
)

# Whitespace a cell is stripped of.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
STRIP = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)

SQL: dict[str, str] = {}


def add(name: str, statement: str, extra: dict[str, str] | None = None) -> None:
    SQL[name] = with_tables(statement, extra)


add("project_rename", "SELECT * FROM source1_pilots")
add("filter_status",
    "SELECT flight_id, arrival_time FROM source1_flights WHERE status = 'scheduled'")
add("max_key_customers",
    "SELECT coalesce(max(customer_id), 1)::BIGINT AS max_id FROM source2_customers")
add("lineage_stamp", f"""
SELECT *, {TS1} AS start_date, 1::INTEGER AS source_id, 1::INTEGER AS insert_id,
       0::INTEGER AS update_id, TRUE AS is_current FROM source1_customers""")
add("flight_durations", """
SELECT flight_id, date_diff('minute', departure_time, arrival_time) AS minutes,
       round(date_diff('second', departure_time, arrival_time) / 3600.0, 6)::DOUBLE AS hours
FROM source2_flights WHERE arrival_time IS NOT NULL""")

_SCORES = ("seat_comfort", "cabin_staff_service", "food_and_beverages",
           "inflight_entertainment", "value_for_money", "ground_service",
           "wifi_and_connectivity")
_RAW = {
    "raw": """
SELECT event_id, ts, event_type,
       CASE WHEN event_id % 10 = 9 THEN '' ELSE 'Air ' || event_type END AS airlines,
       CASE WHEN event_id % 3 = 0 THEN 'Trip Verified | ' ELSE '' END
         || coalesce(text, props) AS body,
       CASE event_id % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'true' ELSE 'False' END AS flag,
""" + ",\n".join(
        f"""CASE (event_id + {k}) % 4 WHEN 0 THEN '' WHEN 1 THEN '4.0'
            WHEN 2 THEN ' ' || (event_id + {k}) % 6 || ' '
            ELSE ((event_id + {k}) % 6)::VARCHAR END AS {c}"""
        for k, c in enumerate(_SCORES)
    ) + "\nFROM events LEFT JOIN documents ON event_id = doc_id",
    "cleansed": f"""
SELECT event_id, event_type AS seat_type, flag = 'True' AS recommended,
       strftime(ts, '%Y-%m-%d') AS source_date,
       replace(trim(CASE WHEN len(string_split(body, '|')) = 2 THEN string_split(body, '|')[2]
                    ELSE body END, {STRIP}), chr(10), ' ') AS content,
""" + ",\n".join(
        f"CASE WHEN regexp_full_match(trim({c}), '[0-9]+') THEN trim({c})::INTEGER ELSE 0 END"
        f" AS {c}"
        for c in _SCORES
    ) + "\nFROM raw WHERE airlines <> ''",
}
_RATED = _SCORES[1:]
add("review_cleanse", f"""
SELECT *, round(coalesce(({' + '.join(_RATED)})::DOUBLE
       / nullif({' + '.join(f'({c} <> 0)::INTEGER' for c in _RATED)}, 0), 0), 6) AS rating
FROM cleansed""", _RAW)

add("review_raw_csv", "SELECT * REPLACE (round(rating, 6) AS rating) FROM raw_versions", {
    **_RAW,
    "raw_staged": f"""
SELECT c.event_id % (SELECT max(o_orderkey) + 1 FROM orders) AS flight_id, e.user_id AS customer_id,
       c.seat_type AS seat_class, content,
       coalesce(({' + '.join(_RATED)})::DOUBLE
         / nullif({' + '.join(f'({c} <> 0)::INTEGER' for c in _RATED)}, 0), 0) AS rating,
       recommended, seat_comfort, cabin_staff_service, food_and_beverages, inflight_entertainment,
       value_for_money, source_date::TIMESTAMP AS date_published
FROM cleansed c JOIN events e USING (event_id)""",
    "raw_versions": opened("airline_reviews", 1, "SELECT * FROM raw_staged", "0"),
})
add("source_parquet", """
SELECT airplane_id AS id, model, registration_number, fuel_consumption_per_hour,
       maintenance_days::INTEGER AS maintenance_days FROM source1_airplanes""")
add("insert_select_pilots", f"""
SELECT pilot_id + 1 AS pilot_sk, *, {TS1} AS start_date, 1::INTEGER AS source_id,
       1::INTEGER AS insert_id, 0::INTEGER AS update_id, TRUE AS is_current FROM source1_pilots""")
add("truncated_tables", """
SELECT 'pilots' AS table_name, count(*) AS n_before, 0::BIGINT AS n_after FROM source1_pilots
UNION ALL SELECT 'airplanes', count(*), 0 FROM source1_airplanes""")

for _query, _table in {
    "resolve_flights": "flights", "resolve_crew_bridge": "flight_cabin_crew",
    "resolve_bookings": "flight_bookings", "resolve_reviews": "airline_reviews",
}.items():
    add(_query, f"""
SELECT * EXCLUDE ({TABLES[_table][0]}, start_date, source_id, insert_id, update_id, is_current)
FROM wh1_{_table}""")

add("flight_endpoint_bridge", """
SELECT DISTINCT flight_id, airport_id, airport_sk FROM source2_flights
JOIN (SELECT airport_id, max_by(airport_sk, start_date) AS airport_sk
      FROM wh2_airports GROUP BY airport_id)
  ON airport_id = departure_airport_id OR airport_id = arrival_airport_id""")


def _diff(name: str, table: str, **options: object) -> None:
    key = ", ".join(TABLES[table][1])
    add(name, f"SELECT {key}, closes IS NULL AS is_new, coalesce(closes, 0) AS closes"
        f" FROM differing", {"differing": changes(table, **options)})


_diff("diff_changed_keys", "customers")
_diff("diff_reviews", "airline_reviews")
_diff("diff_null_safe", "airline_reviews", null_safe=True)
_diff("diff_strict_flights", "flights", strict=("airplane_id",))
_diff("diff_strict_bookings", "flight_bookings", strict=("flight_id", "customer_id"))

add("scd2_close", "SELECT * FROM wh2_flights WHERE NOT is_current")
add("scd2_insert", "SELECT * FROM wh2_customers WHERE insert_id = 2")
for _table in TABLES:
    _short = _table.replace("flight_bookings", "bookings").replace("airline_reviews", "reviews")
    add(f"scd2_{_short}", f"SELECT * FROM wh2_{_table}")
add("scd2_close_missing", "SELECT * FROM all_closed", {
    "all_closed": merged(
        "customers", "changes_customers",
        " UNION SELECT customer_sk FROM wh1_customers"
        " WHERE customer_id NOT IN (SELECT customer_id FROM source2_customers)")})
add("scd2_current", "SELECT * FROM wh2_customers WHERE is_current")
add("scd2_as_of", "SELECT * FROM wh2_flights WHERE insert_id = 1")
add("scd2_as_of_later", "SELECT * FROM wh2_flights WHERE is_current")
add("scd2_latest", """
SELECT * FROM wh2_flights
QUALIFY row_number() OVER (PARTITION BY flight_id ORDER BY start_date DESC, flight_sk DESC) = 1""")
add("lineage_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, insert_id, update_id, source_id, count(*) AS n_rows"
    f" FROM wh2_{t} GROUP BY ALL" for t in TABLES))
add("load_report", " UNION ALL ".join(f"""
SELECT '{t}' AS table_name, inserted::BIGINT AS n_inserted, closed::BIGINT AS n_closed,
       (changed - inserted)::BIGINT AS n_unresolved
FROM (SELECT (SELECT count(*) FROM wh2_{t} WHERE insert_id = 2) AS inserted,
             (SELECT count(*) FROM wh2_{t} WHERE update_id = 2) AS closed,
             (SELECT count(*) FROM changes_{t}) AS changed)""" for t in TABLES))

for _table in STAR_KEYS:
    add(_table, f"SELECT * FROM star_{_table}")
add("dim_date", """
SELECT calendar.*, coalesce(n, 0)::BIGINT AS n_departures FROM calendar
LEFT JOIN (SELECT departure_time::DATE AS departed, count(*) AS n
           FROM source2_flights GROUP BY 1) ON date = departed""")
add("star_delete_expired", """
SELECT * FROM star1_fact_booking WHERE flight_booking_sk NOT IN
  (SELECT flight_booking_sk FROM wh2_flight_bookings WHERE NOT is_current)""")
add("star_insert_absent", """
SELECT * FROM star1_dim_customer
UNION ALL
SELECT customer_sk, full_name, email, frequent_flyer FROM wh2_customers
WHERE is_current AND customer_sk NOT IN (SELECT customer_sk FROM star1_dim_customer)""")


_STAR_COLUMNS = {
    "dim_airport": "airport_sk code name city country",
    "dim_airplane": "airplane_sk model registration_number fuel_consumption_per_hour* maintenance_days",
    "dim_pilot": "pilot_sk name license_number",
    "dim_customer": "customer_sk full_name email frequent_flyer",
    "dim_flight": "flight_sk flight_number departure_airport_sk arrival_airport_sk departure_datetime"
                  " arrival_datetime airplane_sk pilot_sk copilot_sk status is_ferry_flight",
    "fact_flight": "flight_sk departure_date_sk arrival_date_sk delay_minutes"
                   " estimated_flight_hours* is_ferry_flight",
    "fact_booking": "flight_booking_sk flight_sk customer_sk seat_number",
    "fact_review": "airline_review_sk flight_sk customer_sk seat_class rating* recommended"
                   " seat_comfort cabin_staff_service food_and_beverages inflight_entertainment"
                   " value_for_money date_published_sk",
}


def _all_rows(prefix: str) -> str:
    """Key and content of every row; a column marked with a star is a double."""
    def text(column: str) -> str:
        name = column.rstrip("*")
        value = f"{name}::DECIMAL(18,6)" if column.endswith("*") else name
        return f"coalesce({value}::VARCHAR, '~')"

    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {sk} AS sk,"
        f" concat_ws('|', {', '.join(map(text, _STAR_COLUMNS[t].split()))}) AS content"
        f" FROM {prefix}{t}" for t, sk in STAR_KEYS.items())


add("star_refresh", _all_rows("star_"))
add("star_all_versions", _all_rows("starall_"))

# CSV files hold no NULL texts: what was NULL comes back empty.
add("review_csv_round_trip",
    "SELECT * REPLACE (coalesce(content, '') AS content) FROM source2_airline_reviews")
_STREAMED = {
    "streamed_source": "SELECT * REPLACE (coalesce(content, '') AS content)"
                       " FROM source2_airline_reviews",
    "streamed_changes": changes("airline_reviews").replace(
        "source2_airline_reviews", "streamed_source"),
    "streamed_reviews": merged("airline_reviews", "streamed_changes"),
}
add("batch_flights", "SELECT * FROM wh2_flights")
add("batch_reviews_streamed", "SELECT * FROM streamed_reviews", _STREAMED)
add("batch_star", _all_rows("star_").replace("star_fact_review", "streamed_fact"), {
    **_STREAMED,
    **{f"star_{t}": CTES[f"star_{t}"].replace("wh2_airline_reviews", "streamed_reviews")
       for t in ("dim_flight", "dim_customer")},
    "streamed_fact": CTES["star_fact_review"].replace("wh2_airline_reviews", "streamed_reviews"),
})


def _reported(batch: int, table: str, versions: str, changed: str) -> str:
    return f"""
SELECT {batch}::INTEGER AS batch_id, '{table}' AS table_name, inserted, closed,
       n_changed - inserted AS unresolved, 'ok' AS status
FROM (SELECT (SELECT count(*) FROM {versions} WHERE insert_id = {batch}) AS inserted,
             (SELECT count(*) FROM {versions} WHERE update_id = {batch}) AS closed,
             (SELECT count(*) FROM {changed}) AS n_changed)"""


add("batch_timed", "SELECT * FROM wh2_airports")
add("batch_after_failure", "SELECT * FROM wh1_customers")
add("batch_two_streams",
    "SELECT flight_id, customer_id, date_published, rating, content FROM wh1_airline_reviews")
add("batch_close_missing_streamed", "SELECT * FROM wh1_airline_reviews")
add("batch_report", " UNION ALL ".join(
    [_reported(1, t, f"wh1_{t}", f"source1_{t}") for t in TABLES]
    + [_reported(2, t, f"wh2_{t}", f"changes_{t}") for t in TABLES if t != "airline_reviews"]
    + [_reported(2, "airline_reviews", "streamed_reviews", "streamed_changes")]), _STREAMED)

_COLUMNS = ["id", "flight_number", "departure_airport_id", "arrival_airport_id", "departure_time",
            "arrival_time", "delay_minutes", "status", "pilot_id", "copilot_id", "airplane_id",
            "is_ferry_flight", "estimated_flight_hours"]
add("audit_not_null", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({'flight_id' if c == 'id' else c} IS NULL)"
    f" AS n_null FROM source2_flights" for c in _COLUMNS))
add("audit_constraints", """
SELECT 'pilots' AS table_name, 'key' AS rule, 'id' AS columns, 2 * count(*)::BIGINT AS n_rows
FROM source2_pilots WHERE pilot_id % 3 = 0
UNION ALL SELECT 'customers', 'not null', 'email', count(*) FROM source2_customers
WHERE customer_id % 7 = 0
UNION ALL SELECT 'airplanes', 'unique', 'registration_number', count(*) FROM source2_airplanes
WHERE airplane_id % 50 = 0
UNION ALL SELECT 'flights', 'reference', 'airplane_id', count(*) FROM source2_flights
WHERE flight_id % 11 = 0
UNION ALL SELECT 'flights', 'enum', 'status', count(*) FROM source2_flights
WHERE flight_id % 13 = 0
UNION ALL SELECT 'flight_bookings', 'reference', 'customer_id', count(*)
FROM source2_flight_bookings WHERE customer_id NOT IN (SELECT customer_id FROM source2_customers)
HAVING count(*) > 0""")
add("audit_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
add("audit_unique_registration", """
SELECT registration_number, 2::BIGINT AS n_rows FROM source2_airplanes WHERE airplane_id % 4 = 0""")
add("audit_warehouse", """
SELECT * FROM (
SELECT 'flights' AS table_name, 'reference' AS rule, 'pilot_sk' AS columns, count(*) AS n_rows
FROM wh2_flights WHERE pilot_id % 7 = 0
UNION ALL SELECT 'flights', 'reference', 'copilot_sk', count(*) FROM wh2_flights WHERE copilot_id % 7 = 0
UNION ALL SELECT 'dim_airport', 'key', 'airport_sk', 2 * count(*) FROM star_dim_airport
WHERE airport_sk % 2 = 0
UNION ALL SELECT 'fact_booking', 'not null', 'seat_number', count(*) FROM star_fact_booking
WHERE flight_booking_sk % 5 = 0
UNION ALL SELECT 'dim_flight', 'enum', 'status', count(*) FROM star_dim_flight WHERE flight_sk % 3 = 0
UNION ALL SELECT 'fact_flight', 'reference', 'departure_date_sk', count(*) FROM star_fact_flight
WHERE departure_date_sk IN (SELECT date_sk FROM calendar WHERE year >= 1998)
UNION ALL SELECT 'fact_flight', 'reference', 'arrival_date_sk', count(*) FROM star_fact_flight
WHERE arrival_date_sk IN (SELECT date_sk FROM calendar WHERE year >= 1998)
UNION ALL SELECT 'fact_review', 'reference', 'date_published_sk', count(*) FROM star_fact_review
WHERE date_published_sk IN (SELECT date_sk FROM calendar WHERE year >= 1998))
WHERE n_rows > 0""")
add("audit_fk", """
SELECT flight_id AS ref, count(*) AS n_rows FROM source2_flight_bookings
WHERE flight_id NOT IN (SELECT flight_id FROM wh2_flights) GROUP BY ALL""")
add("audit_single_current", """
SELECT flight_id, count(*) AS n_rows FROM wh2_flights WHERE is_current OR flight_id % 2 = 0
GROUP BY ALL HAVING count(*) > 1""")
add("audit_enum", """
SELECT o_orderstatus AS value, count(*) AS n_rows FROM orders
WHERE o_orderstatus NOT IN ('scheduled', 'delayed', 'cancelled') GROUP BY ALL""")


def _overlaps(name: str, intervals: str) -> None:
    add(name, f"""
SELECT * FROM (
  SELECT entity_id, id, start_time, max(end_time) OVER (
    PARTITION BY entity_id ORDER BY start_time, id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS busy_until
  FROM ({intervals}))
WHERE busy_until > start_time""")


_BLOCK = ("flight_id AS id, departure_time AS start_time,"
          " departure_time + INTERVAL 300 MINUTE AS end_time FROM source2_flights")
_overlaps("audit_schedule_conflict", f"SELECT airplane_id AS entity_id, {_BLOCK}")
_overlaps("audit_pilot_conflict", f"""
SELECT pilot_id AS entity_id, {_BLOCK} WHERE pilot_id IS NOT NULL
UNION ALL SELECT copilot_id, {_BLOCK} WHERE copilot_id IS NOT NULL""")
for _query, _table, _ref, _id in (
    ("audit_crew_conflict", "flight_cabin_crew", "cabin_crew_id", "flight_cabin_crew_id"),
    ("audit_passenger_conflict", "flight_bookings", "customer_id", "flight_booking_id"),
):
    _overlaps(_query, f"""
SELECT {_ref} AS entity_id, {_id} AS id, departure_time AS start_time, arrival_time AS end_time
FROM source2_{_table} JOIN source2_flights USING (flight_id) WHERE arrival_time IS NOT NULL""")
add("audit_continuity", """
SELECT * FROM (
  SELECT flight_id AS id, airplane_id, lag(arrival_airport_id) OVER (
    PARTITION BY airplane_id ORDER BY departure_time, flight_id) AS previous_airport_id,
    departure_airport_id FROM source2_flights)
WHERE previous_airport_id <> departure_airport_id""")
_RULES = {
    "block_time": "date_diff('minute', departure_time, arrival_time) <> 210",
    "estimated_hours": "estimated_flight_hours <> 3.5",
    "delay_range": "delay_minutes <> 0 AND (delay_minutes < 15 OR delay_minutes > 120)",
    "delay_status": "status <> 'cancelled' AND (status = 'delayed') <> (delay_minutes > 0)",
    "cancelled_state": "status = 'cancelled' AND (arrival_time IS NOT NULL"
                       " OR pilot_id IS NOT NULL OR copilot_id IS NOT NULL OR is_ferry_flight)",
    "same_airport": "departure_airport_id = arrival_airport_id",
    "same_pilot": "pilot_id = copilot_id",
}
add("audit_rules", " UNION ALL ".join(
    f"SELECT flight_id AS id, '{rule}' AS rule FROM broken_flights WHERE {test}"
    for rule, test in _RULES.items()), {"broken_flights": """
SELECT * REPLACE (
  arrival_time + to_minutes(CASE WHEN flight_id % 23 = 0 THEN 5 ELSE 0 END) AS arrival_time,
  CASE WHEN flight_id % 29 = 0 THEN 4.0 ELSE estimated_flight_hours END::DOUBLE AS estimated_flight_hours,
  CASE WHEN flight_id % 31 = 0 THEN departure_airport_id ELSE arrival_airport_id END AS arrival_airport_id,
  CASE WHEN flight_id % 37 = 0 THEN pilot_id ELSE copilot_id END AS copilot_id,
  is_ferry_flight OR flight_id % 41 = 0 AS is_ferry_flight)
FROM source2_flights"""})
add("audit_occupancy", """
SELECT flight_id, coalesce(c.n, 0)::BIGINT AS n_crew, coalesce(b.n, 0)::BIGINT AS n_passengers
FROM source2_flights
LEFT JOIN (SELECT flight_id, count(*) AS n FROM source2_flight_cabin_crew GROUP BY 1) c
  USING (flight_id)
LEFT JOIN (SELECT flight_id, count(*) AS n FROM source2_flight_bookings GROUP BY 1) b
  USING (flight_id)
WHERE status = 'scheduled' AND (n_crew NOT BETWEEN 2 AND 4 OR n_passengers NOT BETWEEN 120 AND 160)
""")

add("q_delay_by_airport", """
SELECT a.code AS airport_code, d.year, d.month, count(*) AS n_flights,
       count(*) FILTER (f.delay_minutes > 0) AS n_delayed,
       round(avg(f.delay_minutes), 6) AS avg_delay, max(f.delay_minutes) AS max_delay
FROM star_fact_flight f JOIN star_dim_flight USING (flight_sk)
JOIN star_dim_airport a ON departure_airport_sk = a.airport_sk
JOIN calendar d ON departure_date_sk = d.date_sk
GROUP BY ALL""")
add("q_bookings_by_route", """
SELECT dep.code AS departure_code, arr.code AS arrival_code, count(*) AS n_bookings,
       count(DISTINCT flight_sk) AS n_flights
FROM star_fact_booking JOIN star_dim_flight USING (flight_sk)
JOIN star_dim_airport dep ON departure_airport_sk = dep.airport_sk
JOIN star_dim_airport arr ON arrival_airport_sk = arr.airport_sk
GROUP BY ALL""")
add("q_ratings_by_class", """
SELECT seat_class, count(*) AS n_reviews, round(avg(rating), 6) AS avg_rating,
       round(avg(recommended::INTEGER), 6) AS recommend_share,
       round(avg(seat_comfort), 6) AS avg_seat_comfort
FROM star_fact_review GROUP BY ALL""")
add("q_frequent_flyer", """
SELECT * FROM (
  SELECT frequent_flyer, count(*) AS n_bookings, count(DISTINCT customer_sk) AS n_customers_booked
  FROM star_fact_booking JOIN star_dim_customer USING (customer_sk) GROUP BY ALL)
FULL JOIN (
  SELECT frequent_flyer, count(*) AS n_reviews, round(avg(rating), 6) AS avg_rating
  FROM star_fact_review JOIN star_dim_customer USING (customer_sk) GROUP BY ALL)
USING (frequent_flyer)""")
add("q_fuel_by_model", """
SELECT model, count(*) AS n_flights, round(sum(estimated_flight_hours), 6) AS flight_hours,
       round(sum(estimated_flight_hours * fuel_consumption_per_hour), 6) AS fuel
FROM star_fact_flight JOIN star_dim_flight USING (flight_sk)
JOIN star_dim_airplane USING (airplane_sk)
GROUP BY ALL""")
