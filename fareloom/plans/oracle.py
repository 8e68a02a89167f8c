"""The registered queries as SQL over the same tables, for comparison."""

from __future__ import annotations

from fareloom.labels import ENGLISH, PORTUGUESE

# The trip view of `events`, from the table itself.
TRIPS = """
trips AS (
  SELECT *,
         strftime(pickup, '%Y-%m') AS file_month,
         (floor(epoch(dropoff)) - floor(epoch(pickup))) / 60 AS minutes
  FROM (
    SELECT *,
           CASE WHEN event_id % 37 = 0 THEN NULL
                ELSE pickup + ((event_id * 7919) % 1500 - 30) * INTERVAL '1' MINUTE END AS dropoff
    FROM (
      SELECT event_id, user_id, value,
             CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'yellow' ELSE 'green' END AS fleet,
             ts + (event_id % 5) * INTERVAL '30' DAY AS pickup,
             CASE WHEN event_id % 17 = 0 THEN NULL
                  ELSE CAST((event_id * 7) % 13 AS DOUBLE) END AS pax,
             CASE WHEN event_id % 23 = 0 THEN NULL
                  WHEN event_id % 29 = 0 THEN -value
                  WHEN event_id % 31 = 0 THEN value * 20
                  ELSE value END AS amount,
             CASE WHEN event_id % 19 = 0 THEN NULL
                  ELSE CAST((event_id * 31) % 1100 AS DOUBLE) / 10 END AS distance
      FROM events
    )
  )
)"""

RULES = {
    "not_null": "pickup IS NOT NULL AND dropoff IS NOT NULL AND amount IS NOT NULL",
    "non_negative": "amount >= 0",
    "time_order": "pickup <= dropoff",
    "passenger_range": "(pax IS NULL OR pax BETWEEN 0 AND 10)",
    "amount_cap": "amount <= 1000",
    "duration_range": "minutes BETWEEN 1 AND 1440",
    "distance_cap": "(distance IS NULL OR distance <= 100)",
}
BRONZE_WHERE = " AND ".join(f"({rule})" for rule in list(RULES.values())[:4])
SILVER_WHERE = " AND ".join(f"({rule})" for rule in list(RULES.values())[4:])


def switch(subject: str, texts, first: int = 0) -> str:
    arms = " ".join(f"WHEN {first + i} THEN '{text}'" for i, text in enumerate(texts))
    return f"CASE {subject} {arms} END"


def weekday(labels) -> str:
    return switch("dayofweek(pickup)", labels.weekdays)


def period(labels) -> str:
    return switch("hour(pickup) // 6", labels.periods)


BRONZE = f"bronze AS (SELECT * FROM trips WHERE {BRONZE_WHERE})"
SILVER = f"""silver AS (
  SELECT * REPLACE (CASE WHEN coalesce(pax, 0) = 0 THEN 1 ELSE pax END AS pax)
  FROM bronze WHERE {SILVER_WHERE}
)"""


def rollup_cte(source: str) -> str:
    return f"""gold AS (
  SELECT fleet AS taxi_type,
         CAST(year(pickup) AS INTEGER) AS pickup_year,
         CAST(month(pickup) AS INTEGER) AS pickup_month,
         CAST(hour(pickup) AS INTEGER) AS pickup_hour,
         {period(PORTUGUESE)} AS pickup_period,
         {weekday(PORTUGUESE)} AS pickup_dayname,
         dayofweek(pickup) IN (0, 6) AS is_weekend,
         count(*) AS total_trips,
         avg(amount) AS avg_total_amount,
         sum(amount) AS sum_total_amount,
         avg(pax) AS avg_passenger_count,
         sum(pax) AS sum_passenger_count,
         avg(minutes) AS avg_trip_duration,
         min(amount) AS min_total_amount,
         max(amount) AS max_total_amount,
         strftime(pickup, '%Y-%m') AS year_month
  FROM {source}
  GROUP BY ALL
)"""


GOLD = rollup_cte("silver")

# Order lines as trips.
LINES = f"""lines AS (
  SELECT *, (floor(epoch(dropoff)) - floor(epoch(pickup))) / 60 AS minutes
  FROM (
    SELECT l_returnflag AS fleet, l_shipdate AS pickup,
           l_shipdate + CAST(l_quantity AS BIGINT) * INTERVAL '1' MINUTE AS dropoff,
           l_quantity * 20 AS amount, CAST(l_linenumber AS DOUBLE) AS pax,
           CAST(NULL AS DOUBLE) AS distance
    FROM lineitem
  )
),
kept_lines AS (
  SELECT * REPLACE (CASE WHEN coalesce(pax, 0) = 0 THEN 1 ELSE pax END AS pax)
  FROM lines WHERE {BRONZE_WHERE} AND {SILVER_WHERE}
)"""


def over(stage: str, select: str) -> str:
    """A statement with the layers up to `stage` in front of it."""
    chain = {"trips": TRIPS, "bronze": BRONZE, "silver": SILVER, "gold": GOLD}
    ctes = []
    for name, text in chain.items():
        ctes.append(text)
        if name == stage:
            break
    return "WITH " + ",\n".join(ctes) + "\n" + select


def quarantined() -> str:
    """Rows per layer, partition and exact combination of failed rules."""

    def judged(rules: list[str]) -> str:
        names = ", ".join(
            f"CASE WHEN NOT coalesce({RULES[name]}, FALSE) THEN '{name}' END" for name in rules
        )
        return f"coalesce(nullif(array_to_string(list_filter([{names}], lambda x: x IS NOT NULL), '+'), ''), 'kept')"

    names = list(RULES)
    partitions = (
        "fleet AS taxi_type, CAST(year(pickup) AS INTEGER) AS pickup_year, "
        "CAST(month(pickup) AS INTEGER) AS pickup_month"
    )
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, {partitions}, {judged(rules)} AS reasons, count(*) AS n_rows "
        f"FROM trips WHERE {where} GROUP BY ALL"
        for layer, rules, where in (
            ("bronze", names[:4], "TRUE"),
            ("silver", names[4:], BRONZE_WHERE),
        )
    )


def over_lines(select: str) -> str:
    return f"WITH {LINES},\n{rollup_cte('kept_lines')}\n{select}"


def rounded_gold(source: str = "gold", tail: str = "") -> str:
    measures = ", ".join(
        f"round({name}, 6) AS {name}"
        for name in (
            "avg_total_amount",
            "sum_total_amount",
            "avg_passenger_count",
            "sum_passenger_count",
            "avg_trip_duration",
            "min_total_amount",
            "max_total_amount",
        )
    )
    return f"""SELECT taxi_type, pickup_year, pickup_month, pickup_hour, pickup_period,
       pickup_dayname, is_weekend, total_trips, year_month, {measures}
FROM {source} {tail}"""


TRIPS_SUM = "CAST(sum(total_trips) AS BIGINT)"
FARE = "round(sum(sum_total_amount) / nullif(sum(total_trips), 0), 2)"
PAX = "round(sum(sum_passenger_count) / nullif(sum(total_trips), 0), 2)"
REVENUE = "round(sum(sum_total_amount), 2)"
CELLS = "round(avg(avg_total_amount), 2)"
MAY = "pickup_year = 2024 AND pickup_month = 5"
YELLOW = "taxi_type = 'yellow'"


def share(where: str = "TRUE") -> str:
    whole = f"(SELECT sum(total_trips) FROM gold WHERE {where})"
    return f"round(CAST(sum(total_trips) * 100.0 / {whole} AS DOUBLE), 2)"


def report(name: str, columns: str, tail: str = "") -> str:
    """A statement over gold, with the heading the answer has."""
    title = ENGLISH.titles.get(name)
    heading = f"'{title}' AS analysis, " if title else ""
    return over("gold", f"SELECT {heading}{columns} FROM gold {tail}")


def summary(in_month: str) -> str:
    trips_text, revenue_text, first, second = ENGLISH.indicators
    title = ENGLISH.titles["exec_summary"]
    return over(
        "gold",
        f"""SELECT '{title}' AS analysis, unnest(['{trips_text}', '{revenue_text}', '{first}', '{second}']) AS indicator,
       unnest([
         format('{{:,}}', CAST(sum(total_trips) AS BIGINT)),
         '$' || format('{{:,.2f}}', sum(sum_total_amount)),
         '$' || format('{{:,.2f}}', sum(sum_total_amount) FILTER ({YELLOW})
                                    / sum(total_trips) FILTER ({YELLOW})),
         format('{{:,.2f}}', sum(sum_passenger_count) FILTER ({in_month})
                             / sum(total_trips) FILTER ({in_month}))
       ]) AS result
FROM gold""",
    )


def answers() -> dict[str, str]:
    demand = f"""CASE WHEN pickup_hour IN (7, 8, 9) THEN '{ENGLISH.demand[0]}'
                      WHEN pickup_hour IN (17, 18, 19) THEN '{ENGLISH.demand[1]}'
                      WHEN pickup_hour IN (22, 23) THEN '{ENGLISH.demand[2]}'
                      ELSE '{ENGLISH.demand[3]}' END"""
    month_columns = (
        f"year_month, {CELLS} AS mean_of_cells, {FARE} AS weighted_mean, "
        f"{TRIPS_SUM} AS total_trips, {REVENUE} AS total_revenue"
    )
    month_tail = f"WHERE {YELLOW} GROUP BY year_month"
    may_hours = f"WHERE {MAY} GROUP BY pickup_hour"
    hour_columns = f"pickup_hour, {PAX} AS avg_passengers, {TRIPS_SUM} AS total_trips"
    weekday_text, weekend_text = ENGLISH.day_types
    months_in_type = "WHERE TRUE GROUP BY taxi_type, year_month"
    return {
        "q1_main": report(
            "q1_main",
            f"{FARE} AS avg_total_amount, {TRIPS_SUM} AS total_trips, {REVENUE} AS total_revenue",
            f"WHERE {YELLOW}",
        ),
        "q1_monthly": report("q1_monthly", month_columns, month_tail),
        "q1_share": report(
            "q1_share", f"{month_columns}, {share(YELLOW)} AS percentage_trips_month", month_tail
        ),
        "q2_main": report(
            "q2_main", f"{hour_columns}, sum(sum_passenger_count) AS total_passengers", may_hours
        ),
        "q2_peaks": report("q2_peaks", f"{hour_columns}, {demand} AS demand_period", may_hours),
        "q2_period": report(
            "q2_period",
            f"pickup_period, {PAX} AS avg_passengers, {TRIPS_SUM} AS total_trips, "
            f"{share(MAY)} AS percentage_trips",
            f"WHERE {MAY} GROUP BY pickup_period",
        ),
        "q2_top3": report(
            "q2_top3", hour_columns, f"{may_hours} ORDER BY avg_passengers DESC, pickup_hour LIMIT 3"
        ),
        "fleet_compare": report(
            "fleet_compare",
            f"taxi_type, {FARE} AS avg_fare, {PAX} AS avg_passengers, {TRIPS_SUM} AS total_trips, "
            f"{REVENUE} AS total_revenue, {share()} AS percentage_market",
            "GROUP BY taxi_type",
        ),
        "monthly_evolution": report("monthly_evolution", EVOLUTION, "GROUP BY year_month"),
        "top5_hours": report(
            "top5_hours",
            f"pickup_hour, {TRIPS_SUM} AS total_trips, {FARE} AS avg_fare, "
            f"{PAX} AS avg_passengers, {share()} AS percentage_trips",
            "GROUP BY pickup_hour ORDER BY total_trips DESC, pickup_hour LIMIT 5",
        ),
        "weekend_split": report(
            "weekend_split",
            f"CASE WHEN is_weekend THEN '{weekend_text}' ELSE '{weekday_text}' END AS day_type, "
            f"{TRIPS_SUM} AS trips, {FARE} AS avg_fare, {PAX} AS avg_passengers, "
            f"{share()} AS percentage_trips",
            "GROUP BY is_weekend",
        ),
        "weekend_fare_gap": over(
            "gold",
            f"""SELECT CASE WHEN rest > work THEN '{weekend_text}' ELSE '{weekday_text}' END AS dearer_side,
       round((greatest(rest, work) / least(rest, work) - 1) * 100, 1) AS gap_pct
FROM (SELECT (SELECT {FARE} FROM gold WHERE is_weekend) AS rest,
             (SELECT {FARE} FROM gold WHERE NOT is_weekend) AS work)
WHERE rest IS NOT NULL AND work IS NOT NULL""",
        ),
        "trips_by_dayname": report(
            "trips_by_dayname",
            f"pickup_dayname, {TRIPS_SUM} AS total_trips, {CELLS} AS mean_of_cells",
            "GROUP BY pickup_dayname",
        ),
        "fare_by_type_month": report(
            "fare_by_type_month",
            f"taxi_type, year_month, {TRIPS_SUM} AS total_trips, {FARE} AS avg_fare",
            months_in_type,
        ),
        "trips_by_type_month": report(
            "trips_by_type_month",
            f"taxi_type, year_month, {TRIPS_SUM} AS total_trips",
            months_in_type,
        ),
        **{
            f"peak_{name}": report(
                f"peak_{name}",
                f"{key}, {TRIPS_SUM} AS trips",
                f"GROUP BY {key} ORDER BY trips DESC, {key} LIMIT 1",
            )
            for name, key in (
                ("type", "taxi_type"),
                ("hour", "pickup_hour"),
                ("month", "year_month"),
            )
        },
        "validate_gold": report(
            "validate_gold",
            f"count(*) AS total_gold_records, count(DISTINCT taxi_type) AS taxi_types, "
            f"count(DISTINCT year_month) AS available_months, min(pickup_year) AS min_year, "
            f"max(pickup_year) AS max_year, {TRIPS_SUM} AS total_aggregated_trips",
        ),
        "validate_coverage": report(
            "validate_coverage",
            f"taxi_type, year_month, {TRIPS_SUM} AS trips, "
            "count(DISTINCT pickup_hour) AS hours_covered",
            months_in_type,
        ),
        "exec_summary": summary("WHERE pickup_month = 5"),
        "exec_summary_year": summary(f"WHERE {MAY}").replace(
            f"'{ENGLISH.titles['exec_summary']}' AS analysis, ", ""
        ),
        "final_metrics": report(
            "final_metrics",
            f"{TRIPS_SUM} AS total_trips, {REVENUE} AS total_revenue, "
            "count(DISTINCT taxi_type) AS taxi_types, count(DISTINCT year_month) AS months_analysed, "
            f"(SELECT {FARE} FROM gold WHERE {YELLOW}) AS answer_1, "
            f"(SELECT {PAX} FROM gold WHERE pickup_month = 5) AS answer_2",
        ),
        "explore_gold": over(
            "gold",
            rounded_gold(
                tail=f"WHERE {YELLOW} AND year_month = '2024-05' "
                "ORDER BY pickup_hour, pickup_dayname LIMIT 10"
            ),
        ),
        "gold_sample": over(
            "gold",
            rounded_gold(
                tail="ORDER BY taxi_type, pickup_year, pickup_month, pickup_hour, pickup_dayname LIMIT 3"
            ),
        ),
    }


EVOLUTION = (
    f"year_month, {TRIPS_SUM} AS monthly_trips, {FARE} AS avg_fare_month, "
    f"{PAX} AS avg_passengers_month, {REVENUE} AS monthly_revenue"
)
PICKUP, DROPOFF = "pickup AS tpep_pickup_datetime", "dropoff AS tpep_dropoff_datetime"
FILE = "fleet || '_tripdata_' || file_month || '.parquet'"
LINE_BYTES = "CAST(sum(strlen(concat_ws(',', event_id, fleet, user_id)) + 1) AS BIGINT)"
MANIFEST = (
    f"SELECT {FILE} AS source_file, fleet AS taxi_type, file_month AS year_month, "
    f"{LINE_BYTES} AS n_bytes, {LINE_BYTES} / 1048576 AS size_mb FROM trips GROUP BY fleet, file_month"
)
# The row that the checksum digests: names in order, each with its value if it has one.
CHECKED = {
    "VendorID": "CAST(user_id AS VARCHAR)",
    "event_id": "CAST(event_id AS VARCHAR)",
    "fare_amount": "CAST(CAST(round(value * 1000000) AS BIGINT) AS VARCHAR)",
    "passenger_count": "CAST(CAST(round(pax * 1000000) AS BIGINT) AS VARCHAR)",
    "source_file": FILE,
    "taxi_type": "fleet",
    "total_amount": "CAST(CAST(round(amount * 1000000) AS BIGINT) AS VARCHAR)",
    "tpep_dropoff_datetime": "CAST(epoch_us(dropoff) AS VARCHAR)",
    "tpep_pickup_datetime": "CAST(epoch_us(pickup) AS VARCHAR)",
    "trip_distance": "CAST(CAST(round(distance * 1000000) AS BIGINT) AS VARCHAR)",
    "year_month": "file_month",
}
ROW_TEXT = " || '|' || ".join(
    f"coalesce('{name}=' || {value}, '{name}')" for name, value in CHECKED.items()
)
CHECKSUM = f"""SELECT fleet AS taxi_type, file_month AS year_month, count(*) AS n_rows,
       CAST(sum(CAST('0x' || substr(md5({ROW_TEXT}), 1, 15) AS BIGINT)) AS VARCHAR) AS checksum
FROM trips GROUP BY fleet, file_month"""
KEPT = (
    "event_id, fleet AS taxi_type, amount AS total_amount, pax AS passenger_count, "
    "minutes AS trip_duration_minutes"
)
PARTS = (
    "CAST(year(pickup) AS INTEGER) AS pickup_year, CAST(month(pickup) AS INTEGER) AS pickup_month, "
    "CAST(hour(pickup) AS INTEGER) AS pickup_hour, "
    "CAST(dayofweek(pickup) + 1 AS INTEGER) AS pickup_dayofweek"
)
NUMBERED = (
    "event_id, fleet AS taxi_type, CAST(year(pickup) AS INTEGER) AS pickup_year, "
    "CAST(month(pickup) AS INTEGER) AS pickup_month"
)


def fare(labels) -> str:
    low, mid, high, top = labels.fare_bands
    return (
        f"CASE WHEN amount > 50 OR amount IS NULL THEN '{top}' WHEN amount > 25 THEN '{high}' "
        f"WHEN amount > 10 THEN '{mid}' ELSE '{low}' END"
    )


def party(labels) -> str:
    one, two, few, many = labels.party_sizes
    return (
        f"CASE WHEN pax = 1 THEN '{one}' WHEN pax = 2 THEN '{two}' "
        f"WHEN pax >= 3 AND pax <= 4 THEN '{few}' ELSE '{many}' END"
    )


def kept(rule: str) -> str:
    return over("trips", f"SELECT {KEPT} FROM trips WHERE {rule}")


def derived(columns: str) -> str:
    return over("trips", f"SELECT event_id, {columns} FROM trips")


def union(rows) -> str:
    return "\nUNION ALL\n".join(rows)


def sources_and_sinks() -> dict[str, str]:
    partitions = "taxi_type, pickup_year, pickup_month"
    counts = union(
        f"SELECT '{layer}' AS layer, '{layer}_trips' AS table_name, count(*) AS n_rows, "
        f"TRUE AS gold_ready FROM {source}"
        for layer, source in (
            ("raw", "trips"),
            ("bronze", "bronze"),
            ("silver", "silver"),
            ("gold", "gold"),
        )
    )
    return {
        "scan_parquet": over(
            "trips",
            f"""SELECT event_id, user_id AS "VendorID", pax AS passenger_count, amount AS total_amount,
       CASE WHEN fleet = 'yellow' THEN pickup END AS tpep_pickup_datetime,
       CASE WHEN fleet = 'yellow' THEN dropoff END AS tpep_dropoff_datetime,
       CASE WHEN fleet = 'green' THEN pickup END AS lpep_pickup_datetime,
       CASE WHEN fleet = 'green' THEN dropoff END AS lpep_dropoff_datetime,
       distance AS trip_distance, value AS fare_amount
FROM trips""",
        ),
        "ingest_multi_source": over(
            "trips",
            f"""SELECT {FILE} AS source_file, fleet AS taxi_type, file_month AS year_month,
       'ok' AS status, count(*) AS n_rows
FROM trips GROUP BY fleet, file_month
UNION ALL
SELECT 'green_tripdata_2024-06.parquet', 'green', '2024-06', 'failed', 0""",
        ),
        "ingest_type_drift": over(
            "trips",
            f"""SELECT source_file, column_name, count(*) AS n_rows, count(*) FILTER (lost) AS n_lost
FROM (
  SELECT {FILE} AS source_file, fleet, month(pickup) AS m,
         unnest([{{'column_name': 'total_amount', 'lost': amount IS NULL}},
                 {{'column_name': 'passenger_count', 'lost': pax IS NULL}},
                 {{'column_name': 'tpep_dropoff_datetime', 'lost': dropoff IS NULL}}], recursive := true)
  FROM trips
)
WHERE (column_name = 'total_amount') = (fleet = 'yellow') AND m = CASE fleet WHEN 'yellow' THEN 4 ELSE 2 END
GROUP BY source_file, column_name HAVING count(*) FILTER (lost) > 0""",
        ),
        "provenance_columns": derived(
            f"fleet AS taxi_type, file_month AS year_month, {FILE} AS source_file, "
            "TRUE AS has_ingestion_time"
        ),
        "file_name_parse": over(
            "trips",
            f"""SELECT {FILE} AS source_file, fleet AS taxi_type, file_month AS year_month,
       count(*) AS n_rows
FROM trips GROUP BY fleet, file_month""",
        ),
        "manifest_sizes": over("trips", MANIFEST),
        "manifest_total": over(
            "trips",
            f"SELECT count(*) AS n_entries, sum(size_mb) AS total_mb FROM ({MANIFEST})",
        ),
        "refresh_new_files": over("gold", rounded_gold()),
        "refresh_after_death": over("gold", rounded_gold()),
        "refresh_one_month": over(
            "trips",
            "SELECT fleet AS taxi_type, count(*) AS n_rows, TRUE AS few_files FROM trips "
            "WHERE year(pickup) = 2024 AND month(pickup) = 5 GROUP BY fleet",
        ),
        "zorder_write": over(
            "silver",
            "SELECT unnest(['tpep_pickup_datetime', 'total_amount']) AS column_name, "
            "count(*) AS n_rows, TRUE AS skips_half FROM silver",
        ),
        "hash_tree_diff": over(
            "silver",
            f"""SELECT {partitions}, event_id, side,
       round(CASE side WHEN 'after' THEN amount + 1 ELSE amount END, 6) AS total_amount
FROM (SELECT {NUMBERED}, amount FROM silver WHERE month(pickup) = 5 AND event_id % 50 = 3),
     (SELECT unnest(['before', 'after']) AS side)""",
        ),
        "quarantine_write": over("trips", quarantined()),
        "manifest_missing": over(
            "trips",
            """SELECT taxi_type, year_month, taxi_type || '_tripdata_' || year_month || '.parquet' AS source_file
FROM (SELECT unnest(['yellow', 'green']) AS taxi_type), (SELECT '2024-0' || unnest(range(1, 8)) AS year_month)
WHERE (taxi_type, year_month) NOT IN (SELECT (fleet, file_month) FROM trips)
  AND NOT (taxi_type = 'green' AND year_month = '2024-06')""",
        ),
        "ingest_success_rate": over(
            "trips",
            """SELECT n + 1 AS n_entries, n AS n_ok, CAST(1 AS BIGINT) AS n_failed,
       round(n * 100.0 / (n + 1), 1) AS success_rate_pct
FROM (SELECT count(DISTINCT (fleet, file_month)) AS n FROM trips)""",
        ),
        "layer_read": over("gold", rounded_gold()),
        "layer_counts": over("gold", counts),
        "table_stats": over("gold", f"SELECT layer, n_rows FROM ({counts})"),
        "write_roundtrip": over(
            "silver",
            f"SELECT {NUMBERED}, {PICKUP}, amount AS total_amount, pax AS passenger_count, "
            "minutes AS trip_duration_minutes FROM silver",
        ),
        "write_partitioned": over(
            "silver",
            f"""SELECT {partitions}, count(*) AS n_rows,
       round(sum(CASE WHEN pickup_month = 5 THEN 2 * amount ELSE amount END), 2) AS revenue
FROM (SELECT {NUMBERED}, amount FROM silver) GROUP BY {partitions}""",
        ),
        "schema_merge": derived(
            "amount AS total_amount, CASE WHEN fleet = 'green' THEN value END AS fare_amount"
        ),
        "compact_table": over(
            "silver",
            "SELECT fleet AS taxi_type, count(*) AS n_rows, TRUE AS fewer_files "
            "FROM silver GROUP BY fleet",
        ),
        "clustered_write": over(
            "silver",
            f"SELECT {partitions}, count(*) AS n_rows, CAST(0 AS BIGINT) AS overlapping_files "
            f"FROM (SELECT {NUMBERED} FROM silver) GROUP BY {partitions}",
        ),
    }


def unification() -> dict[str, str]:
    required = (
        ("VendorID", "VendorID", "user_id"),
        ("passenger_count", "passenger_count", "pax"),
        ("total_amount", "total_amount", "amount"),
        ("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup"),
        ("tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropoff"),
    )
    checks = []
    for fleet in ("yellow", "green"):
        for name, native, column in required:
            absent = fleet == "green" and column == "pax"
            checks.append(
                f"SELECT '{fleet}' AS taxi_type, '{name}' AS required_column, "
                f"'{native if fleet == 'green' else name}' AS native_column, "
                f"{not absent} AS present, count(*) AS n_rows, "
                f"{'CAST(0 AS BIGINT)' if absent else f'count({column})'} AS n_filled "
                f"FROM trips WHERE fleet = '{fleet}'"
            )
    contract = (
        f'user_id AS "VendorID", pax AS passenger_count, amount AS total_amount, '
        f"{PICKUP}, {DROPOFF}, distance AS trip_distance, value AS fare_amount, fleet AS taxi_type"
    )
    return {
        "union_sources": over(
            "trips",
            f'SELECT event_id, fleet AS taxi_type, user_id AS "VendorID", amount AS total_amount, '
            f"{PICKUP}, {DROPOFF}, distance AS trip_distance, value AS fare_amount FROM trips",
        ),
        "standardize_schema": over(
            "trips", f"SELECT {contract}, event_id FROM trips"
        ),
        "split_rename_union": derived(f"fleet AS taxi_type, {PICKUP}, {DROPOFF}"),
        "fill_missing_columns": over(
            "trips",
            f"""SELECT event_id, user_id AS "VendorID", CAST(NULL AS DOUBLE) AS passenger_count,
       amount AS total_amount, {PICKUP}, CAST(NULL AS TIMESTAMP) AS tpep_dropoff_datetime
FROM trips""",
        ),
        "project_contract": over("trips", f"SELECT {contract} FROM trips"),
        "contract_check": over("trips", union(checks)),
        "distinct_sources": over("trips", "SELECT DISTINCT fleet AS taxi_type FROM trips"),
    }


def rules_and_columns() -> dict[str, str]:
    bounds = (
        "(pax IS NULL OR pax BETWEEN 0 AND 10) AND (amount IS NULL OR amount BETWEEN 0 AND 1000) "
        "AND (distance IS NULL OR distance BETWEEN 0 AND 100)"
    )
    first_four = {f"clean_{name}": kept(rule) for name, rule in list(RULES.items())[:4]}
    demand = switch(
        "hour(pickup)",
        [
            ENGLISH.demand[0 if 7 <= h <= 9 else 1 if 17 <= h <= 19 else 2 if h >= 22 else 3]
            for h in range(24)
        ],
    )
    return {
        **first_four,
        "bronze_clean": over("bronze", f"SELECT {KEPT} FROM bronze"),
        "silver_rules": over(
            "bronze",
            "SELECT event_id, amount AS total_amount, distance AS trip_distance, "
            f"minutes AS trip_duration_minutes FROM bronze WHERE {SILVER_WHERE}",
        ),
        "rules_declared": over(
            "trips",
            "SELECT event_id, pax AS passenger_count, amount AS total_amount, "
            f"distance AS trip_distance FROM trips WHERE {bounds}",
        ),
        "date_parts": derived(PARTS),
        "day_name": derived(
            f"{weekday(PORTUGUESE)} AS pickup_dayname, strftime(pickup, '%A') AS day_name_en"
        ),
        "day_period": derived(
            f"{period(PORTUGUESE)} AS pickup_period, {period(ENGLISH)} AS period_en"
        ),
        "trip_duration": derived("minutes AS trip_duration_minutes"),
        "year_month_label": derived("strftime(pickup, '%Y-%m') AS year_month"),
        "weekend_flag": derived("dayofweek(pickup) IN (0, 6) AS is_weekend"),
        "fare_band": derived(f"{fare(PORTUGUESE)} AS fare_category"),
        "party_size": derived(f"{party(PORTUGUESE)} AS passenger_category"),
        "demand_band": derived(f"{demand} AS demand_period"),
        "impute_passengers": over(
            "bronze",
            "SELECT event_id, CASE WHEN coalesce(pax, 0) = 0 THEN 1 ELSE pax END "
            "AS passenger_count FROM bronze",
        ),
        "bronze_derive": derived(
            f"{PARTS}, {weekday(PORTUGUESE)} AS pickup_dayname, "
            f"{period(PORTUGUESE)} AS pickup_period, minutes AS trip_duration_minutes"
        ),
        "silver_enrich": over(
            "bronze",
            f"SELECT event_id, dayofweek(pickup) IN (0, 6) AS is_weekend, "
            f"{fare(PORTUGUESE)} AS fare_category, {party(PORTUGUESE)} AS passenger_category "
            "FROM bronze",
        ),
    }


def profiling() -> dict[str, str]:
    columns = {
        "VendorID": "user_id",
        "passenger_count": "pax",
        "total_amount": "amount",
        "tpep_pickup_datetime": "pickup",
        "tpep_dropoff_datetime": "dropoff",
        "trip_distance": "distance",
        "fare_amount": "value",
    }
    doubles = ("pax", "amount", "distance", "value")
    bounds = {"passenger_count": (0, 10), "total_amount": (0, 1000), "trip_distance": (0, 100)}

    def failed(rule: str) -> str:
        return f"NOT coalesce({rule}, FALSE)"

    reasons = ", ".join(
        f"CASE WHEN {failed(rule)} THEN '{name}' END" for name, rule in RULES.items()
    )
    measured = {
        "total_amount": "amount",
        "trip_distance": "distance",
        "trip_duration_minutes": "minutes",
    }
    return {
        "dq_null_rate": over(
            "trips",
            union(
                f"SELECT '{name}' AS column_name, count(*) AS n_rows, "
                f"count(*) - count({column}) AS n_null, "
                + (
                    f"count(*) FILTER (WHERE isnan({column})) AS n_nan, "
                    if column in doubles
                    else "CAST(0 AS BIGINT) AS n_nan, "
                )
                + f"round((count(*) - count({column})) / count(*), 6) AS null_rate FROM trips"
                for name, column in columns.items()
            ),
        ),
        "dq_outliers": over(
            "trips",
            union(
                f"SELECT '{name}' AS column_name, "
                f"count(*) FILTER (WHERE {columns[name]} < {bounds[name][0]} "
                f"OR {columns[name]} > {bounds[name][1]}) AS n_outliers, "
                f"min({columns[name]}) AS min_value, max({columns[name]}) AS max_value FROM trips"
                for name in ("total_amount", "passenger_count")
            ),
        ),
        "dq_time_order": over(
            "trips",
            """SELECT fleet AS taxi_type, count(*) AS n_rows,
       count(*) FILTER (WHERE pickup < dropoff) AS n_before,
       count(*) FILTER (WHERE pickup = dropoff) AS n_equal,
       count(*) FILTER (WHERE pickup > dropoff) AS n_after,
       count(*) FILTER (WHERE pickup IS NULL OR dropoff IS NULL) AS n_unknown
FROM trips GROUP BY fleet""",
        ),
        "dq_ranges": over(
            "trips",
            union(
                f"SELECT '{name}' AS column_name, CAST({low} AS DOUBLE) AS low, "
                f"CAST({high} AS DOUBLE) AS high, count({columns[name]}) AS n_checked, "
                f"count(*) FILTER (WHERE {columns[name]} < {low}) AS n_below, "
                f"count(*) FILTER (WHERE {columns[name]} > {high}) AS n_above, "
                f"round(count(*) FILTER (WHERE {columns[name]} BETWEEN {low} AND {high}) "
                f"/ count({columns[name]}), 6) AS valid_rate FROM trips"
                for name, (low, high) in bounds.items()
            ),
        ),
        "dq_report": over(
            "trips",
            union(
                f"SELECT '{name}' AS rule, count(*) AS n_checked, "
                f"count(*) FILTER (WHERE {failed(rule)}) AS n_failed, "
                f"round(count(*) FILTER (WHERE {failed(rule)}) / count(*), 6) AS failed_rate "
                "FROM trips"
                for name, rule in RULES.items()
            ),
        ),
        "dq_reject_reasons": over(
            "trips",
            f"""SELECT taxi_type, reasons, count(*) AS n_rows
FROM (SELECT fleet AS taxi_type, concat_ws('+', {reasons}) AS reasons FROM trips)
WHERE reasons <> '' GROUP BY taxi_type, reasons""",
        ),
        "dq_group_quantiles": over(
            "silver",
            union(
                f"SELECT fleet AS taxi_type, CAST(month(pickup) AS INTEGER) AS pickup_month, "
                f"'{name}' AS metric, count({column}) AS n_values, "
                f"round(quantile_disc({column}, 0.5), 6) AS p500, "
                f"round(quantile_disc({column}, 0.95), 6) AS p950 FROM silver "
                f"GROUP BY ALL HAVING count({column}) > 0"
                for name, column in measured.items()
            ),
        ),
        "dq_sketches": over(
            "silver",
            union(
                f"SELECT '{name}' AS metric, {p} AS per_mille, count({column}) AS n_values, "
                f"TRUE AS within_bound FROM silver"
                for name, column in measured.items()
                for p in (250, 500, 750, 950)
            ),
        ),
        "dq_distribution": over(
            "silver",
            union(
                f"SELECT '{name}' AS metric, count({column}) AS n_values, "
                f"round(min({column}), 6) AS min_value, round(max({column}), 6) AS max_value, "
                f"round(avg({column}), 6) AS mean_value, "
                f"round(stddev_samp({column}), 6) AS stddev_value, "
                + ", ".join(
                    f"round(quantile_disc({column}, {p / 1000}), 6) AS p{p}"
                    for p in (250, 500, 750, 950)
                )
                + " FROM silver"
                for name, column in measured.items()
            ),
        ),
    }


def all_oracles() -> dict[str, str]:
    """Statements by query name."""
    return {
        **sources_and_sinks(),
        **unification(),
        **rules_and_columns(),
        "gold_rollup": over("gold", rounded_gold()),
        "gold_rollup_lines": over_lines(rounded_gold()),
        "monthly_evolution_lines": over_lines(f"SELECT {EVOLUTION} FROM gold GROUP BY year_month"),
        **answers(),
        "q1_detail_raw": over(
            "bronze",
            """SELECT file_month AS year_month, round(avg(amount), 2) AS avg_fare, count(*) AS trips
FROM bronze WHERE fleet = 'yellow' AND amount > 0 GROUP BY file_month""",
        ),
        "q2_hour_raw": over(
            "bronze",
            """SELECT CAST(hour(pickup) AS INTEGER) AS hour, round(avg(pax), 2) AS avg_passengers,
       count(*) AS trips
FROM bronze WHERE file_month = '2024-05' AND pax > 0 GROUP BY hour(pickup)""",
        ),
        **profiling(),
        "dq_checksum": over("trips", CHECKSUM),
    }
