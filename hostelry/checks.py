"""Checking SQL for the registered queries, written for a plain SQL engine.

Each statement starts from the benchmark tables and states the answer in the
most direct form, without the reductions the Spark plans use.
"""

from __future__ import annotations

from .schemas import SOURCE_TABLES, TABLES
from .sources.sample_tables import STATEMENTS, damaged_statement

_AS_OF = "TIMESTAMP '2001-12-31 00:00:00'"
_BASE = {name: name for name in ("part", "nation", "region", "events", "orders")}

# Column lists of the source tables; NULL stands for columns without data.
_SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE",
}
_FILLED = {
    "apartments": {"id", "title", "source", "price", "currency", "listing_created_on", "is_active"},
    "apartment_attributes": {
        "id", "apartment_id", "category", "amenities", "square_feet", "cityname", "state",
    },
    "user_viewings": {"id", "user_id", "apartment_id", "viewed_at", "is_wishlisted", "call_to_action"},
    "bookings": {
        "id", "booking_id", "user_id", "apartment_id", "booking_date", "checkin_date",
        "checkout_date", "total_price", "currency", "booking_status", "payment_status", "num_guests",
    },
}


def _typed(name: str, data_type: str, filled: bool) -> str:
    return f"CAST({name if filled else 'NULL'} AS {_SQL_TYPES[data_type]}) AS {name}"


def _source(table: str) -> str:
    columns = [
        _typed(f.name, f.dataType.simpleString(), f.name in _FILLED[table])
        for f in TABLES[table].schema
    ]
    if table == "apartment_attributes":
        columns.append("price")
    return f"SELECT {', '.join(columns)} FROM ({STATEMENTS[table].format(**_BASE)}) s"


_STAGES = {
    **{table: _source(table) for table in SOURCE_TABLES},
    "e_apartments": f"""
SELECT *, {_AS_OF} AS processed_at,
  CAST(CASE WHEN listing_created_on IS NOT NULL
    THEN date_diff('day', CAST(listing_created_on AS DATE), CAST({_AS_OF} AS DATE)) ELSE 0 END
    AS INTEGER) AS days_since_listing,
  price AS price_usd
FROM apartments""",
    "e_viewings": f"""
SELECT *, {_AS_OF} AS processed_at, 0 AS viewing_duration_seconds FROM user_viewings""",
    "e_bookings": f"""
SELECT *, {_AS_OF} AS processed_at,
  CAST(CASE WHEN checkin_date IS NOT NULL AND checkout_date IS NOT NULL
    THEN date_diff('day', CAST(checkin_date AS DATE), CAST(checkout_date AS DATE)) ELSE 0 END
    AS INTEGER) AS booking_duration_days
FROM bookings""",
    "e_attributes": f"""
SELECT *, {_AS_OF} AS processed_at,
  CASE WHEN square_feet > 0 AND price IS NOT NULL THEN price / square_feet ELSE 0.0::DOUBLE END
    AS price_per_sqft
FROM apartment_attributes""",
    "c_apartments": f"""
SELECT id AS apartment_id, title, source, price, currency, listing_created_on, is_active,
  last_modified_timestamp, days_since_listing AS days_listed, {_AS_OF} AS etl_inserted_at
FROM e_apartments""",
    "c_details": f"""
SELECT apartment_id, category, bathrooms, bedrooms, fee, has_photo, pets_allowed, square_feet,
  price_per_sqft, address, cityname AS city, state, latitude, longitude,
  amenities AS amenities_text, {_AS_OF} AS etl_inserted_at
FROM e_attributes""",
    "activity": f"""
SELECT user_id, apartment_id, 'viewing' AS activity_type, viewed_at AS activity_date,
  is_wishlisted, call_to_action, CAST(NULL AS BIGINT) AS booking_id,
  CAST(NULL AS TIMESTAMP) AS checkin_date, CAST(NULL AS TIMESTAMP) AS checkout_date,
  CAST(NULL AS INTEGER) AS stay_duration, CAST(NULL AS DOUBLE) AS total_price,
  CAST(NULL AS VARCHAR) AS booking_status, CAST(NULL AS VARCHAR) AS payment_status,
  CAST(NULL AS INTEGER) AS num_guests, {_AS_OF} AS etl_inserted_at, id AS source_id
FROM e_viewings
UNION ALL
SELECT user_id, apartment_id, 'booking', booking_date, NULL, NULL, booking_id, checkin_date,
  checkout_date, booking_duration_days, total_price, booking_status, payment_status, num_guests,
  {_AS_OF}, id
FROM e_bookings""",
    "listing": """
SELECT a.apartment_id, a.title, a.price, coalesce(a.is_active, false) AS active,
  a.listing_created_on, d.city, d.state, d.price_per_sqft
FROM c_apartments a LEFT JOIN c_details d USING (apartment_id)""",
    "booked": """
SELECT *, CAST(date_trunc('week', activity_date) AS DATE) AS week,
  CASE WHEN checkin_date IS NOT NULL AND checkout_date IS NOT NULL THEN stay_duration END AS stay,
  count(*) OVER (PARTITION BY user_id ORDER BY activity_date
    RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) > 1 AS is_repeat
FROM activity WHERE activity_type = 'booking'""",
    "night": """
SELECT DISTINCT apartment_id, CAST(unnest(generate_series(CAST(checkin_date AS DATE),
  CAST(checkout_date AS DATE) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS night
FROM booked WHERE booking_status = 'confirmed'""",
    "locations": """
SELECT coalesce(b.week, v.week) AS week_start_date, coalesce(b.city, v.city) AS city,
  coalesce(b.state, v.state) AS state, coalesce(b.n, 0) AS total_bookings,
  coalesce(v.n, 0) AS total_viewings, b.avg_price,
  CASE WHEN coalesce(v.n, 0) > 0 THEN 100.0::DOUBLE * coalesce(b.n, 0) / v.n ELSE 0.0::DOUBLE END
    AS booking_conversion_rate
FROM (SELECT week, city, state, count(*) AS n,
        CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_price
      FROM booked LEFT JOIN listing USING (apartment_id) GROUP BY ALL) b
FULL JOIN (SELECT CAST(date_trunc('week', activity_date) AS DATE) AS week, city, state,
        count(*) AS n
      FROM activity LEFT JOIN listing USING (apartment_id)
      WHERE activity_type = 'viewing' GROUP BY ALL) v
  ON b.week = v.week AND b.city IS NOT DISTINCT FROM v.city
    AND b.state IS NOT DISTINCT FROM v.state""",
    "top_listings": """
SELECT * EXCLUDE (rank) FROM (
  SELECT w.week AS week_start_date, w.apartment_id, l.title, l.city, l.state, w.total_revenue,
    w.total_bookings, w.avg_stay_duration,
    100.0::DOUBLE * coalesce(n.nights, 0) / 7 AS occupancy_rate,
    row_number() OVER (PARTITION BY w.week ORDER BY w.total_revenue DESC, w.apartment_id) AS rank
  FROM (SELECT week, apartment_id,
          CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
          count(*) AS total_bookings, avg(stay) AS avg_stay_duration
        FROM booked WHERE booking_status = 'confirmed' GROUP BY ALL) w
  LEFT JOIN (SELECT apartment_id, CAST(date_trunc('week', night) AS DATE) AS week,
          count(*) AS nights FROM night GROUP BY ALL) n USING (apartment_id, week)
  LEFT JOIN listing l USING (apartment_id))
WHERE rank <= 10""",
    "engagement": """
SELECT w.week AS week_start_date,
  CAST(sum(coalesce(f.n, 0)) OVER (ORDER BY w.week) AS BIGINT) AS total_users,
  w.active_users, coalesce(f.n, 0) AS new_users, coalesce(b.n, 0) AS total_bookings,
  CASE WHEN coalesce(b.bookers, 0) > 0 THEN CAST(b.n AS DOUBLE) / b.bookers ELSE 0.0::DOUBLE END
    AS avg_bookings_per_user,
  b.avg_duration AS avg_booking_duration,
  CASE WHEN coalesce(b.bookers, 0) > 0 THEN 100.0::DOUBLE * b.repeaters / b.bookers
    ELSE 0.0::DOUBLE END AS repeat_customer_rate
FROM (SELECT CAST(date_trunc('week', activity_date) AS DATE) AS week,
        count(DISTINCT user_id) AS active_users FROM activity GROUP BY ALL) w
LEFT JOIN (SELECT CAST(date_trunc('week', first) AS DATE) AS week, count(*) AS n
      FROM (SELECT min(activity_date) AS first FROM activity GROUP BY user_id) GROUP BY ALL) f
  USING (week)
LEFT JOIN (SELECT week, count(*) AS n, count(DISTINCT user_id) AS bookers,
        avg(stay) FILTER (WHERE booking_status = 'confirmed') AS avg_duration,
        count(DISTINCT user_id) FILTER (WHERE is_repeat) AS repeaters
      FROM booked GROUP BY ALL) b USING (week)""",
    "history": """
SELECT h.user_id, h.week AS week_start_date, h.total_bookings, h.total_spend,
  h.avg_booking_duration, f.city AS favorite_city, h.is_repeat_customer
FROM (SELECT user_id, week, count(*) AS total_bookings,
        CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
        avg(stay) AS avg_booking_duration, bool_or(is_repeat) AS is_repeat_customer
      FROM booked GROUP BY ALL) h
LEFT JOIN (SELECT user_id, week, city FROM (
        SELECT user_id, week, city,
          row_number() OVER (PARTITION BY user_id, week ORDER BY count(*) DESC, city) AS rank
        FROM booked JOIN listing USING (apartment_id) GROUP BY user_id, week, city)
      WHERE rank = 1) f USING (user_id, week)""",
    "latest_history": """
SELECT * FROM history WHERE week_start_date = (SELECT max(week_start_date) FROM history)""",
    "latest_listings": """
SELECT * FROM top_listings
WHERE week_start_date = (SELECT max(week_start_date) FROM top_listings)""",
}


def _performance(grain: str) -> str:
    """The listings alive in each period, joined out in full."""
    return f"""
SELECT p.period AS {grain}_start_date, s.avg_price AS avg_listing_price,
  s.median_price AS median_listing_price, coalesce(s.listings, 0) AS total_active_listings,
  coalesce(c.n, 0) AS new_listings,
  CASE WHEN coalesce(s.listings, 0) > 0 THEN 100.0::DOUBLE * coalesce(o.nights, 0) / (s.listings
    * date_diff('day', p.period, CAST(p.period + INTERVAL 1 {grain} AS DATE)))
    ELSE 0.0::DOUBLE END AS occupancy_rate,
  s.avg_rate AS avg_price_per_sqft
FROM (SELECT CAST(unnest(generate_series(
        (SELECT date_trunc('{grain}', min(listing_created_on)) FROM listing),
        (SELECT date_trunc('{grain}', max(activity_date)) FROM activity),
        INTERVAL 1 {grain})) AS DATE) AS period) p
LEFT JOIN (SELECT q.period, count(*) AS listings, avg(price) AS avg_price,
        median(price) AS median_price,
        avg(price_per_sqft) FILTER (WHERE price_per_sqft > 0) AS avg_rate
      FROM listing l JOIN (SELECT DISTINCT CAST(unnest(generate_series(
          (SELECT date_trunc('{grain}', min(listing_created_on)) FROM listing),
          (SELECT date_trunc('{grain}', max(activity_date)) FROM activity),
          INTERVAL 1 {grain})) AS DATE) AS period) q
        ON l.active AND l.listing_created_on < q.period + INTERVAL 1 {grain}
      GROUP BY q.period) s ON s.period = p.period
LEFT JOIN (SELECT CAST(date_trunc('{grain}', listing_created_on) AS DATE) AS period,
        count(*) AS n FROM listing GROUP BY ALL) c ON c.period = p.period
LEFT JOIN (SELECT CAST(date_trunc('{grain}', night) AS DATE) AS period, count(*) AS nights
      FROM night JOIN listing l USING (apartment_id)
      WHERE l.active AND l.listing_created_on
        < date_trunc('{grain}', night) + INTERVAL 1 {grain}
      GROUP BY ALL) o ON o.period = p.period"""


# The snapshots of the history queries, all rows of each.
_STAGES["taken"] = "SELECT k, TIMESTAMP '1998-01-01 00:00:00' + k * INTERVAL 20 DAY AS taken FROM range(6) r(k)"
_STAGES["listed"] = """
SELECT taken, id, is_active AND (id + k) % 5 <> 0 AS is_active,
  CASE WHEN id % 3 = 0 AND k >= 3 THEN price * 2 ELSE price END AS price
FROM apartments, taken WHERE id % 7 <> k"""

_STAGES["performance"] = _performance("week")
_STAGES["monthly"] = _performance("month")
_STAGES |= {f"d_{t}": damaged_statement(t, t) for t in SOURCE_TABLES}

_NEEDS = {
    "e_apartments": ["apartments"], "e_viewings": ["user_viewings"], "e_bookings": ["bookings"],
    "e_attributes": ["apartment_attributes"], "c_apartments": ["e_apartments"],
    "c_details": ["e_attributes"], "activity": ["e_viewings", "e_bookings"],
    "listing": ["c_apartments", "c_details"], "booked": ["activity"], "night": ["booked"],
    "locations": ["activity", "booked", "listing"],
    "top_listings": ["booked", "night", "listing"], "engagement": ["activity", "booked"],
    "history": ["booked", "listing"], "latest_history": ["history"],
    "listed": ["apartments", "taken"],
    "latest_listings": ["top_listings"], "performance": ["activity", "listing", "night"],
    "monthly": ["activity", "listing", "night"], **{f"d_{t}": [t] for t in SOURCE_TABLES},
}


def _with(stages: list[str], statement: str) -> str:
    ordered: list[str] = []

    def add(stage: str) -> None:
        for need in _NEEDS.get(stage, []):
            add(need)
        if stage not in ordered:
            ordered.append(stage)

    for stage in stages:
        add(stage)
    if not ordered:
        return statement
    return "WITH " + ",\n".join(f"{s} AS ({_STAGES[s]})" for s in ordered) + "\n" + statement


def _rounded(names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names.split())


_PERFORMANCE_COLUMNS = (
    "total_active_listings, new_listings, "
    + _rounded("avg_listing_price median_listing_price occupancy_rate avg_price_per_sqft")
)
_LOCATION_COLUMNS = "total_bookings, total_viewings, avg_price, booking_conversion_rate"
_ACTIVITY_COLUMNS = (
    "user_id, apartment_id, activity_type, activity_date, is_wishlisted, call_to_action, "
    "booking_id, checkin_date, checkout_date, stay_duration, total_price, booking_status, "
    "payment_status, num_guests, etl_inserted_at"
)
_LISTING_KPIS = """
  count(id) AS total_listings, count(*) FILTER (WHERE is_active) AS active_listings,
  CAST(sum(CAST(price_usd AS DECIMAL(18,2))) AS DOUBLE) / count(price_usd) AS avg_price,
  min(price_usd) AS min_price, max(price_usd) AS max_price,
  avg(days_since_listing) AS avg_days_listed"""
_VIEWING_KPIS = """
  count(*) AS total_viewings, count(*) FILTER (WHERE is_wishlisted) AS total_wishlisted,
  count(user_id) AS total_users, count(viewing_duration_seconds) AS total_timed_viewings,
  avg(viewing_duration_seconds) AS avg_viewing_duration"""
_BOOKING_KPIS = """
  count(*) AS total_bookings, count(*) FILTER (WHERE booking_status = 'confirmed')
    AS confirmed_bookings,
  CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) / count(total_price)
    AS avg_booking_value,
  CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) AS total_booking_value,
  avg(booking_duration_days) AS avg_booking_duration"""


def _summary(stage: str, value: str) -> str:
    return _with([stage], f"""
SELECT round(avg(v), 6) AS avg_value, round(max(v), 6) AS max_value, round(min(v), 6) AS min_value,
  round(first, 6) AS first_value, round(last, 6) AS last_value, round(last - first, 6) AS trend,
  round(CASE WHEN first <> 0 THEN (last - first) / first * 100 END, 6) AS trend_pct
FROM (SELECT {value} AS v,
    first_value({value}) OVER (ORDER BY week_start_date) AS first,
    first_value({value}) OVER (ORDER BY week_start_date DESC) AS last FROM {stage})
GROUP BY first, last""")


def _correlation(stage: str, x: str, y: str, where: str = "true") -> str:
    return _with([stage], f"""
SELECT round(CASE WHEN stddev_pop(x) * stddev_pop(y) <> 0
  THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END, 6) AS correlation
FROM (SELECT {x} AS x, {y} AS y FROM {stage}
      WHERE {where} AND {x} IS NOT NULL AND {y} IS NOT NULL)""")


def _histogram(stage: str) -> str:
    return _with([stage], f"""
SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + (hi - lo) / 10 * (b.bin - 1), 6) AS bin_start,
  round(lo + (hi - lo) / 10 * b.bin, 6) AS bin_end,
  (SELECT count(*) FROM {stage} WHERE least(
    CAST(floor((total_bookings - lo) / ((hi - lo) / 10)) AS INTEGER) + 1, 10) = b.bin) AS n
FROM (SELECT unnest(range(1, 11)) AS bin) b, (
  SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5::DOUBLE ELSE min(v) END AS lo,
    CASE WHEN min(v) = max(v) THEN max(v) + 0.5::DOUBLE ELSE max(v) END AS hi
  FROM (SELECT CAST(total_bookings AS DOUBLE) AS v FROM {stage})) s""")


def _density(stage: str) -> str:
    return _with([stage], f"""
SELECT CAST(g.point AS INTEGER) AS point, round(lo + (hi - lo) / 199 * g.point, 6) AS x,
  round(CASE WHEN h > 0 THEN (
    SELECT sum(n * exp(-pow((lo + (hi - lo) / 199 * g.point - v) / h, 2) / 2)) FROM c)
    / (total * h * sqrt(2 * pi())) END, 6) AS density
FROM (SELECT unnest(range(0, 200)) AS point) g, (
  SELECT min(v) AS lo, max(v) AS hi, count(*) AS total,
    stddev_samp(v) * pow(count(*), -0.2) AS h
  FROM (SELECT CAST(total_bookings AS DOUBLE) AS v FROM {stage})) s""").replace(
        "\nSELECT CAST(g.point", f""",
c AS (SELECT CAST(total_bookings AS DOUBLE) AS v, count(*) AS n FROM {stage} GROUP BY ALL)
SELECT CAST(g.point""")


def _not_null(table: str, name: str, columns: list[str]) -> list[str]:
    return [
        f"SELECT '{name}' AS \"table\", 'not_null' AS \"check\", '{c}' AS \"column\", "
        f"count(*) FILTER (WHERE {c} IS NULL) AS violations, count(*) AS rows FROM {table}"
        for c in columns
    ]


def _too_long(table: str, name: str, limits: dict[str, int]) -> list[str]:
    return [
        f"SELECT '{name}' AS \"table\", 'max_length' AS \"check\", '{c}' AS \"column\", "
        f"count(*) FILTER (WHERE strlen({c}) > {n}) AS violations, count(*) AS rows FROM {table}"
        for c, n in limits.items()
    ]


def _unique(table: str, name: str, keys: list[str], check: str) -> str:
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys) if check == "unique" else "true"
    return (
        f"SELECT '{name}' AS \"table\", '{check}' AS \"check\", '{','.join(keys)}' AS \"column\", "
        f"CAST(coalesce(sum(CASE WHEN {known} THEN n - 1 ELSE 0 END), 0) AS BIGINT) AS violations, "
        f"CAST(coalesce(sum(n), 0) AS BIGINT) AS rows "
        f"FROM (SELECT {', '.join(keys)}, count(*) AS n FROM {table} GROUP BY ALL)"
    )


def _foreign(table: str, name: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS \"table\", 'foreign_key' AS \"check\", '{column}' AS \"column\", "
        f"count(*) FILTER (WHERE {column} IS NOT NULL AND {column} NOT IN "
        f"(SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)) AS violations, count(*) AS rows FROM {table}"
    )


def _report(threshold: str = "0.0") -> str:
    parts = []
    for name in SOURCE_TABLES:
        table = TABLES[name]
        broken = f"d_{name}"
        parts += _not_null(broken, name, table.required)
        parts += _too_long(broken, name, table.text_limits)
        parts.append(_unique(broken, name, list(table.key), "primary_key"))
        parts += [_unique(broken, name, [c], "unique") for c in table.unique]
        parts += [_foreign(broken, name, c, f"d_{p}", k) for c, (p, k) in table.parents.items()]
    union = "\nUNION ALL\n".join(parts)
    return _with([f"d_{t}" for t in SOURCE_TABLES], f"""
SELECT *, CASE WHEN rows > 0 THEN round(violations::DOUBLE / rows, 6) ELSE 0.0::DOUBLE END AS rate,
  {threshold}::DOUBLE AS threshold, violations <= {threshold} * rows AS passed
FROM ({union})""")


def _checks_only(stages: list[str], parts: list[str]) -> str:
    union = "\nUNION ALL\n".join(parts)
    return _with(stages, f'SELECT * EXCLUDE ("table") FROM ({union})')


def _profile() -> str:
    fields = [(f.name, f.dataType.simpleString()) for f in TABLES["apartment_attributes"].schema]
    fields.append(("price", "double"))
    parts = [
        f"SELECT {i} AS position, '{n}' AS \"column\", '{t}' AS \"type\", count({n}) AS non_null, "
        f"count(*) AS rows FROM apartment_attributes"
        for i, (n, t) in enumerate(fields, start=1)
    ]
    return _with(["apartment_attributes"], "\nUNION ALL\n".join(parts))


def _lost_values() -> str:
    names = ["id", "booking_date", "booking_status", "num_guests"]
    bad = {"num_guests": "id % 3 = 2"}
    parts = [
        f"SELECT '{n}' AS \"column\", count(*) FILTER (WHERE {bad.get(n, 'false')}) AS violations, "
        f"count(*) AS rows FROM bookings"
        for n in names
    ]
    return _with(["bookings"], "\nUNION ALL\n".join(parts))


# Where the rows of each stored table come from, and the column that is added up.
_STORED = {
    "apartments": ("apartments", "price"),
    "apartment_attributes": ("apartment_attributes", "square_feet"),
    "user_viewings": ("user_viewings", "user_id"), "bookings": ("bookings", "total_price"),
    "curated_apartments": ("c_apartments", "price"),
    "curated_apartment_details": ("c_details", "square_feet"),
    "curated_user_activity": ("activity", "total_price"),
    "pres_rental_performance_weekly": ("performance", "total_active_listings"),
    "pres_rental_performance_monthly": ("monthly", "total_active_listings"),
    "pres_popular_locations_weekly": ("locations", "total_bookings"),
    "pres_top_listings_weekly": ("top_listings", "total_revenue"),
    "pres_user_engagement_weekly": ("engagement", "total_bookings"),
    "pres_user_booking_history": ("history", "total_spend"),
}


def _totals(tables: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, "
        f"CAST(sum(CAST({_STORED[t][1]} AS DECIMAL(18,2))) AS DOUBLE) AS total FROM {_STORED[t][0]}"
        for t in tables
    )


def _pipeline() -> str:
    """Rows and a total of every table that the pipeline stores."""
    metrics = ("SELECT 'presentation_metrics', 1::BIGINT, CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) "
               "FROM e_bookings")
    return _with([s for s, _ in _STORED.values()] + ["e_bookings"], f"{_totals(list(_STORED))}\nUNION ALL\n{metrics}")


def _refreshed() -> str:
    """The same of the tables that late activity changes: as if it had been there from the start."""
    tables = [t for t in _STORED if t.startswith("pres_") or t == "curated_user_activity"]
    return _with([_STORED[t][0] for t in tables], _totals(tables))


def oracle_sql() -> dict[str, str]:
    activity_rate = (
        "CASE WHEN total_users > 0 THEN 100.0::DOUBLE * active_users / total_users "
        "ELSE 0.0::DOUBLE END"
    )
    return {
        "enrich_apartments": _with(["e_apartments"], "SELECT * FROM e_apartments"),
        "enrich_viewings": _with(["e_viewings"], "SELECT * FROM e_viewings"),
        "enrich_viewings_timed": _with(["user_viewings"], """
SELECT id, CAST(CASE WHEN ended IS NOT NULL AND viewed_at IS NOT NULL
    THEN date_diff('day', CAST(viewed_at AS DATE), CAST(ended AS DATE)) * 86400 ELSE 0 END
    AS INTEGER) AS day_seconds,
  CASE WHEN ended IS NOT NULL AND viewed_at IS NOT NULL
    THEN date_diff('second', viewed_at, ended) ELSE 0 END AS exact_seconds
FROM (SELECT id, viewed_at,
    CASE WHEN id % 7 <> 0 THEN viewed_at + (id % 90) * INTERVAL 1 HOUR END AS ended
  FROM user_viewings)"""),
        "enrich_bookings": _with(["e_bookings"], "SELECT * FROM e_bookings"),
        "enrich_attributes": _with(
            ["e_attributes"],
            "SELECT * FROM e_attributes",
        ),
        "constant_currency": _with(["bookings"], "SELECT id, 'EUR' AS currency FROM bookings"),
        "listing_kpis": _with(["e_apartments"], f"SELECT {_LISTING_KPIS} FROM e_apartments"),
        "viewing_kpis": _with(
            ["e_viewings"],
            f"SELECT {_VIEWING_KPIS}, count(DISTINCT user_id) AS distinct_users FROM e_viewings",
        ),
        "booking_kpis": _with(["e_bookings"], f"SELECT {_BOOKING_KPIS} FROM e_bookings"),
        "presentation_metrics": _with(["e_apartments", "e_viewings", "e_bookings"], f"""
SELECT *,
  CASE WHEN total_viewings > 0 THEN total_bookings::DOUBLE / total_viewings
    ELSE 0.0::DOUBLE END AS booking_conversion_rate,
  CASE WHEN total_viewings > 0 THEN total_wishlisted::DOUBLE / total_viewings
    ELSE 0.0::DOUBLE END AS wishlist_rate,
  CASE WHEN active_listings > 0 THEN total_viewings::DOUBLE / active_listings
    ELSE 0.0::DOUBLE END AS avg_viewings_per_listing,
  {_AS_OF} AS generated_at, CAST({_AS_OF} AS DATE) AS metrics_date
FROM (SELECT {_LISTING_KPIS} FROM e_apartments), (SELECT {_VIEWING_KPIS} FROM e_viewings),
  (SELECT {_BOOKING_KPIS} FROM e_bookings)"""),
        "curated_apartments": _with(["c_apartments"], "SELECT * FROM c_apartments"),
        "curated_details": _with(
            ["c_details"],
            "SELECT * FROM c_details",
        ),
        "user_activity_union": _with(
            ["activity"], f"SELECT {_ACTIVITY_COLUMNS}, source_id FROM activity"
        ),
        "user_activity_with_id": _with(["activity"], f"""
SELECT row_number() OVER (ORDER BY activity_date NULLS FIRST, activity_type, source_id)
  AS activity_id, {_ACTIVITY_COLUMNS} FROM activity"""),
        "rental_performance_weekly": _with(
            ["performance"], f"SELECT week_start_date, {_PERFORMANCE_COLUMNS} FROM performance"
        ),
        "rental_performance_monthly": _with(
            ["activity", "listing", "night"],
            f"SELECT month_start_date, {_PERFORMANCE_COLUMNS} FROM ({_performance('month')})",
        ),
        "popular_locations_weekly": _with(
            ["locations"], f"SELECT week_start_date, city, state, {_LOCATION_COLUMNS} FROM locations"
        ),
        "top_listings_weekly": _with(
            ["top_listings"], "SELECT * FROM top_listings"
        ),
        "user_engagement_weekly": _with(["engagement"], "SELECT * FROM engagement"),
        "weekly_active_users": _with(["activity"], """
SELECT CAST(date_trunc('week', activity_date) AS DATE) AS week_start_date,
  count(DISTINCT user_id) AS active_users FROM activity GROUP BY ALL"""),
        "user_booking_history": _with(["history"], "SELECT * FROM history"),
        "price_summary": _summary("performance", "avg_listing_price"),
        "price_summary_display": _with([], f"""
SELECT printf('%.2f', avg_value) AS avg_value, printf('%.2f', max_value) AS max_value,
  printf('%.2f', min_value) AS min_value,
  CASE WHEN trend IS NOT NULL THEN printf('%.2f', trend) END AS trend,
  CASE WHEN trend_pct IS NOT NULL THEN printf('%.1f', trend_pct) END AS trend_pct
FROM ({_summary('performance', 'avg_listing_price')})"""),
        "occupancy_summary": _summary("performance", "occupancy_rate"),
        "top_cities_latest": _with(["locations"], f"""
SELECT city || ', ' || state AS place, strftime(week_start_date, '%Y-%m-%d') AS week,
  {_LOCATION_COLUMNS}
FROM locations WHERE week_start_date = (SELECT max(week_start_date) FROM locations)
ORDER BY locations.total_bookings DESC, city, state LIMIT 10"""),
        "top5_city_pivot": _with(["locations"], f"""
SELECT week_start_date, {', '.join(
    f"max(city) FILTER (WHERE r = {i}) AS city_{i}, "
    f"CAST(sum(total_bookings) FILTER (WHERE r = {i}) AS BIGINT) AS bookings_{i}"
    for i in range(1, 6))}
FROM locations JOIN (SELECT city, row_number() OVER (ORDER BY sum(total_bookings) DESC, city) AS r
  FROM locations WHERE city IS NOT NULL GROUP BY city) USING (city)
WHERE r <= 5 GROUP BY week_start_date"""),
        "top_listings_latest": _with(
            ["latest_listings"], "SELECT * FROM latest_listings"
        ),
        "corr_occupancy_revenue": _correlation("latest_listings", "occupancy_rate", "total_revenue"),
        "bookings_per_user_summary": _summary("engagement", "avg_bookings_per_user"),
        "booking_count_distribution": _with(["latest_history"], """
SELECT total_bookings, count(*) AS n,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM latest_history), 6) AS pct
FROM latest_history GROUP BY total_bookings"""),
        "booking_histogram": _histogram("latest_history"),
        "booking_histogram_all_weeks": _histogram("history"),
        "booking_kde": _density("latest_history"),
        "booking_kde_all_weeks": _density("history"),
        "duration_summary": _summary("engagement", "avg_booking_duration"),
        "corr_duration_spend": _correlation(
            "latest_history", "avg_booking_duration", "total_spend", "total_bookings > 0"
        ),
        "repeat_rate_summary": _summary("engagement", "repeat_customer_rate"),
        "repeat_vs_onetime": _with(["latest_history"], """
SELECT customers, repeat_customers, round(rs, 6) AS repeat_avg_spend,
  round(rd, 6) AS repeat_avg_duration, one_time_customers, round(os, 6) AS one_time_avg_spend,
  round(od, 6) AS one_time_avg_duration,
  round(100.0::DOUBLE * repeat_customers / customers, 6) AS repeat_share_pct,
  round(100.0::DOUBLE * one_time_customers / customers, 6) AS one_time_share_pct,
  round(rs - os, 6) AS spend_difference, round((rs - os) / os * 100, 6) AS spend_uplift_pct,
  round(rd - od, 6) AS duration_difference, round((rd - od) / od * 100, 6) AS duration_uplift_pct
FROM (SELECT count(*) AS customers, count(*) FILTER (WHERE r) AS repeat_customers,
    count(*) FILTER (WHERE NOT r) AS one_time_customers,
    avg(total_spend) FILTER (WHERE r) AS rs, avg(total_spend) FILTER (WHERE NOT r) AS os,
    avg(avg_booking_duration) FILTER (WHERE r) AS rd,
    avg(avg_booking_duration) FILTER (WHERE NOT r) AS od
  FROM (SELECT *, is_repeat_customer AS r FROM latest_history))"""),
        "repeat_customers": _with(["history"], """
SELECT user_id, week_start_date, total_spend
FROM history WHERE is_repeat_customer"""),
        "activity_rate": _with(["engagement"], f"""
SELECT week_start_date, active_users, total_users, round({activity_rate}, 6) AS activity_rate
FROM engagement"""),
        "avg_activity_rate": _with(["engagement"], f"""
SELECT round(avg({activity_rate}), 6) AS avg_activity_rate FROM engagement"""),
        "city_labels": _with(["c_details"], """
SELECT city || ', ' || state AS place, count(*) AS n_listings FROM c_details GROUP BY ALL"""),
        "lookback_activity": _with(["activity"], f"""
SELECT {_ACTIVITY_COLUMNS}, source_id FROM activity
WHERE activity_date >= TIMESTAMP '1998-05-31 00:00:00'
  AND activity_date < TIMESTAMP '1998-07-01 00:00:00'"""),
        "week_bucket_sunday": _with(["bookings"], """
SELECT CAST(booking_date AS DATE) - CAST(dayofweek(booking_date) AS INTEGER) AS week_start_date,
  count(*) AS n_bookings FROM bookings GROUP BY ALL"""),
        "booked_nights": _with(["night"], "SELECT apartment_id, night FROM night"),
        "rolling_repeat": _with(["bookings"], """
SELECT id, user_id, booking_date, n AS bookings_in_window, n > 1 AS is_repeat
FROM (SELECT id, user_id, booking_date, count(*) OVER (PARTITION BY user_id ORDER BY booking_date
    RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS n FROM bookings)"""),
        "dq_not_null": _checks_only(["apartment_attributes"], _not_null(
            "apartment_attributes", "", ["id", "square_feet", "fee"])),
        "dq_pk_duplicates": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
        "dq_unique": _checks_only(["bookings"], [
            _unique("bookings", "", ["booking_id"], "unique"),
            _unique("lineitem", "", ["l_orderkey", "l_linenumber"], "primary_key"),
            _unique("orders", "", ["o_custkey"], "unique"),
        ]),
        "dq_fk_orphans": _checks_only(["apartments", "bookings"], [
            _foreign("bookings", "", "apartment_id", "apartments", "id"),
            _foreign("lineitem", "", "l_orderkey", "orders", "o_orderkey"),
            _foreign("labels", "", "doc_id", "documents", "doc_id"),
            _foreign("apartments", "", "id", "bookings", "apartment_id"),
        ]),
        "unbooked_listings": _with(["apartments", "bookings"], """
SELECT id, count(*) AS n_rows FROM apartments
WHERE id NOT IN (SELECT apartment_id FROM bookings) GROUP BY id"""),
        "dq_varchar_overflow": _checks_only(["apartments"], [
            *_too_long("apartments", "", TABLES["apartments"].text_limits),
            *_too_long("(SELECT text AS title FROM documents)", "", {"title": 255}),
        ]),
        "dq_report": _report(),
        "dq_report_limits": _report("""(CASE "check" WHEN 'primary_key' THEN 0.02
    WHEN 'not_null' THEN 0.1 WHEN 'max_length' THEN 0.05 ELSE 0.5 END)"""),
        "price_density": _with(["bookings"], """,
s AS (SELECT min(v) AS lo, (max(v) - min(v)) / 4095 AS d, (max(v) - min(v)) / 199 AS step, count(*) AS total,
  stddev_samp(v) * pow(count(*), -0.2) AS h FROM (SELECT total_price AS v FROM bookings)),
p AS (SELECT (total_price - lo) / d AS place, least(CAST(floor((total_price - lo) / d) AS INTEGER), 4094) AS cell
  FROM bookings, s WHERE total_price IS NOT NULL),
c AS (SELECT cell, sum(w) AS w FROM (
  SELECT cell, cell + 1 - place AS w FROM p UNION ALL SELECT cell + 1, place - cell FROM p) GROUP BY cell)
SELECT CAST(g.point AS INTEGER) AS point, round(lo + step * g.point, 6) AS x,
  round(1e6::DOUBLE * sum(w * exp(-pow((lo + step * g.point - (lo + d * cell)) / h, 2) / 2))
    / any_value(total * h * sqrt(2 * pi())), 6) AS density
FROM (SELECT unnest(range(0, 200)) AS point) g, s, c GROUP BY g.point, lo, step""".lstrip()),
        "type_conformance": _with(["bookings"], "SELECT * FROM bookings"),
        "lost_values": _lost_values(),
        "profile_columns": _profile(),
        "numeric_summary": _with(["bookings"], "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, "
            f"CAST(max({c}) AS DOUBLE) AS max, "
            + ", ".join(f"round(quantile_cont({c}, {q / 100}), 6) AS p{q}" for q in (25, 50, 75))
            + " FROM bookings"
            for c in ("id", "user_id", "num_guests", "total_price")
        )),
        "first_bookings": _with(["bookings"], "SELECT * FROM bookings ORDER BY id LIMIT 10"),
        "row_count": _with(["bookings"], "SELECT count(*) AS n_rows FROM bookings"),
        "truncate_columns": """
SELECT doc_id, CASE WHEN strlen(text) <= 255 THEN text ELSE left(text, list_max(list_filter(
  range(63, 256), lambda k: strlen(left(text, k)) <= 255))) END AS title
FROM documents""",
        "latest_period_filter": _with(["booked"], """
SELECT booking_id AS id, week AS week_start_date, total_price FROM booked
WHERE week = (SELECT max(week) FROM booked)"""),
        "rows_to_json": _with(["bookings"], """
SELECT '{"id":' || id || ',"user_id":' || user_id || ',"booking_date":"'
  || strftime(booking_date, '%Y-%m-%dT%H:%M:%S') || '","booking_status":"' || booking_status
  || '","num_guests":' || num_guests || ',"etl_inserted_at":null}' AS json FROM bookings"""),
        "snapshot_roundtrip": _with(
            ["bookings"], "SELECT id, user_id, booking_date, total_price FROM bookings"
        ),
        "table_refresh": _with(["bookings"], f"""
SELECT id, apartment_id, booking_date, total_price, currency, {_AS_OF} AS etl_inserted_at
FROM bookings"""),
        "csv_roundtrip": _with(["bookings", "apartments"], """
SELECT b.id, b.apartment_id, b.booking_date, b.total_price, b.currency, a.title, a.is_active
FROM bookings b LEFT JOIN apartments a ON a.id = b.apartment_id"""),
        "load_audit": _with(list(SOURCE_TABLES), "\nUNION ALL\n".join(
            f"SELECT '{t}' AS \"table\", 'ok' AS status, count(*) AS rows FROM {t}"
            for t in SOURCE_TABLES
        )),
        "pipeline_e2e": _pipeline(),
        "partial_refresh": _refreshed(),
        "refreshed_history": _with(["history"], "SELECT * FROM history"),
        "users_by_quarter": _with(["activity"], """
SELECT CAST(date_trunc('quarter', date_trunc('week', activity_date)) AS DATE) AS period,
  count(DISTINCT user_id) AS users, true AS within_error
FROM activity WHERE activity_date IS NOT NULL GROUP BY ALL"""),
        "flat_snapshot": _with(["bookings"], "SELECT id, user_id, total_price FROM bookings"),
        "even_table": _with(
            ["apartment_attributes"], "SELECT id, cityname, square_feet FROM apartment_attributes"
        ),
        "csv_seed": _with(list(SOURCE_TABLES), "\nUNION ALL\n".join(
            f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in SOURCE_TABLES
        )),
        "sorted_table_range": _with(["bookings"], """
SELECT id, apartment_id, booking_date, total_price FROM bookings
WHERE booking_date >= TIMESTAMP '1998-05-31 00:00:00'
  AND booking_date < TIMESTAMP '1998-07-01 00:00:00'"""),
        "hot_key_join": _with(["bookings", "user_viewings"], """
SELECT id, user_id, total_price, n_viewings FROM bookings
LEFT JOIN (SELECT user_id, count(*) AS n_viewings FROM user_viewings GROUP BY ALL) USING (user_id)"""),
        "published_snapshot": _with(
            ["bookings"], "SELECT id, user_id, booking_date, total_price, currency FROM bookings"
        ),
        "manifest_totals": _with(["bookings"], """
SELECT count(*) AS n_rows, min(booking_date) AS oldest, max(booking_date) AS newest FROM bookings"""),
        # Ends of runs, found by comparing each row with the same listing 20 days before and after.
        "listing_validity": _with(["listed"], """
SELECT b.id, b.is_active, b.price, b.taken AS valid_from, (
    SELECT min(e.taken) + INTERVAL 20 DAY FROM listed e WHERE e.id = b.id AND e.taken >= b.taken
      AND e.taken < (SELECT max(taken) FROM taken)
      AND NOT EXISTS (SELECT 1 FROM listed n WHERE n.id = e.id AND n.taken = e.taken + INTERVAL 20 DAY
        AND n.is_active = b.is_active AND n.price = b.price)) AS valid_to
FROM listed b WHERE NOT EXISTS (SELECT 1 FROM listed p WHERE p.id = b.id
  AND p.taken = b.taken - INTERVAL 20 DAY AND p.is_active = b.is_active AND p.price = b.price)"""),
        "active_as_known": _with(["listed"], """
SELECT CAST(w.week AS DATE) AS week_start_date,
  count(*) FILTER (WHERE l.is_active) AS active_as_known,
  (SELECT count(*) FROM listed WHERE is_active AND taken = (SELECT max(taken) FROM taken)) AS active_now
FROM (SELECT unnest(generate_series((SELECT date_trunc('week', min(taken)) FROM taken),
    (SELECT date_trunc('week', max(taken)) FROM taken), INTERVAL 7 DAY)) AS week) w
LEFT JOIN listed l ON l.taken = (
  SELECT max(taken) FROM taken WHERE taken < w.week + INTERVAL 7 DAY)
GROUP BY w.week"""),
        "bucketed_join": _with(["bookings", "apartment_attributes"], """
SELECT apartment_id, cityname, count(*) AS n_bookings,
  CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) AS spend
FROM bookings JOIN apartment_attributes USING (apartment_id) GROUP BY ALL"""),
    }
