"""ANSI SQL for each query, written from the base tables only.

Nothing here goes through JSON parsing or any intermediate dataset: fields,
faults, copies and windows are restated from the rows of ``events``/``orders``.
"""

from __future__ import annotations

# -- base tables as order events ---------------------------------------------------

_EV = """
base AS (
  SELECT event_id AS n, user_id AS u, ts,
    CAST(value AS DECIMAL(12,2)) AS amount,
    CASE event_type WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'paid'
      WHEN 'view' THEN 'processing' WHEN 'purchase' THEN 'completed'
      WHEN 'error' THEN 'cancelled' END AS status
  FROM events
),
ev AS (
  SELECT n,
    '00000000-0000-4000-8000-' || lpad(CAST(n AS VARCHAR), 12, '0') AS event_id,
    CASE status WHEN 'pending' THEN 'order_created' WHEN 'paid' THEN 'order_updated'
      WHEN 'processing' THEN 'order_updated' WHEN 'completed' THEN 'order_completed'
      WHEN 'cancelled' THEN 'order_cancelled' END AS event_type,
    CAST(1 AS INTEGER) AS event_version,
    '10000000-0000-4000-8000-' || lpad(CAST(n // 4 AS VARCHAR), 12, '0') AS order_id,
    '20000000-0000-4000-8000-' || lpad(CAST(u AS VARCHAR), 12, '0') AS customer_id,
    status AS order_status,
    amount AS order_amount,
    CASE u % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'TWD' ELSE 'EUR' END AS currency,
    ts AS event_time,
    '10000000-0000-4000-8000-' || lpad(CAST(n // 4 AS VARCHAR), 12, '0') AS message_key,
    'commerce.orders.v1' AS kafka_topic,
    CAST(u % 3 AS INTEGER) AS kafka_partition,
    n AS kafka_offset,
    ts + INTERVAL 1 SECOND AS kafka_timestamp
  FROM base
)"""

# Spoiled events, some delivered twice. ``fault`` decides which field is broken.
_MSG = (
    _EV
    + """,
spoiled AS (
  SELECT n, n % 40 AS fault,
    CASE n % 40 WHEN 2 THEN NULL WHEN 3 THEN 'not-a-uuid' ELSE event_id END AS event_id,
    CASE n % 40 WHEN 11 THEN NULL WHEN 12 THEN 'order_teleported' ELSE event_type END AS event_type,
    CASE n % 40 WHEN 9 THEN NULL WHEN 10 THEN 0 ELSE event_version END AS event_version,
    CASE n % 40 WHEN 4 THEN NULL WHEN 5 THEN 'not-a-uuid' ELSE order_id END AS order_id,
    CASE n % 40 WHEN 6 THEN NULL WHEN 7 THEN 'not-a-uuid' ELSE customer_id END AS customer_id,
    CASE n % 40 WHEN 13 THEN NULL WHEN 14 THEN 'shipped' ELSE order_status END AS order_status,
    CASE n % 40 WHEN 15 THEN NULL WHEN 16 THEN CAST(0 AS DECIMAL(12,2)) ELSE order_amount END AS order_amount,
    CASE n % 40 WHEN 17 THEN NULL WHEN 18 THEN 'usd' ELSE currency END AS currency,
    CASE n % 40 WHEN 8 THEN NULL ELSE event_time END AS event_time,
    CASE n % 40 WHEN 5 THEN 'not-a-uuid' WHEN 19 THEN NULL WHEN 20 THEN customer_id
      ELSE message_key END AS message_key,
    kafka_topic, kafka_partition, kafka_offset, kafka_timestamp
  FROM ev
),
msg AS (
  SELECT s.* REPLACE (s.kafka_offset + d.shift AS kafka_offset),
    CASE WHEN s.fault = 1 THEN 'this-is-not-json' ELSE
      '{' || concat_ws(',',
        '"event_id":"' || event_id || '"',
        '"event_type":"' || event_type || '"',
        '"event_version":' || CAST(event_version AS VARCHAR),
        '"order_id":"' || order_id || '"',
        '"customer_id":"' || customer_id || '"',
        '"order_status":"' || order_status || '"',
        '"order_amount":"' || CAST(order_amount AS VARCHAR) || '"',
        '"currency":"' || currency || '"',
        '"event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S') ||
          CASE WHEN strftime(event_time, '%f') = '000000' THEN ''
               ELSE '.' || strftime(event_time, '%f') END || 'Z"'
      ) || '}' END AS raw_event
  FROM spoiled s, (VALUES (0), (1000000)) AS d(shift)
  WHERE d.shift = 0 OR s.n % 50 = 0
),
bronze AS (
  SELECT n, message_key, raw_event, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp,
    CASE WHEN fault <> 1 THEN event_id END AS event_id,
    CASE WHEN fault <> 1 THEN event_type END AS event_type,
    CASE WHEN fault <> 1 THEN event_version END AS event_version,
    CASE WHEN fault <> 1 THEN order_id END AS order_id,
    CASE WHEN fault <> 1 THEN customer_id END AS customer_id,
    CASE WHEN fault <> 1 THEN order_status END AS order_status,
    CASE WHEN fault <> 1 THEN order_amount END AS order_amount,
    CASE WHEN fault <> 1 THEN currency END AS currency,
    CASE WHEN fault <> 1 THEN event_time END AS event_time,
    fault <> 1 AS is_valid_json
  FROM msg
)"""
)

_UUID = "'^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$'"
_CHECKED = (
    _MSG
    + f""",
checked AS (
  SELECT *, concat_ws(',',
    CASE WHEN NOT is_valid_json THEN 'invalid_json' END,
    CASE WHEN event_id IS NULL THEN 'missing_event_id' END,
    CASE WHEN NOT regexp_matches(event_id, {_UUID}) THEN 'invalid_event_id' END,
    CASE WHEN order_id IS NULL THEN 'missing_order_id' END,
    CASE WHEN NOT regexp_matches(order_id, {_UUID}) THEN 'invalid_order_id' END,
    CASE WHEN customer_id IS NULL THEN 'missing_customer_id' END,
    CASE WHEN NOT regexp_matches(customer_id, {_UUID}) THEN 'invalid_customer_id' END,
    CASE WHEN event_time IS NULL THEN 'missing_event_time' END,
    CASE WHEN event_version IS NULL THEN 'missing_event_version' END,
    CASE WHEN event_version < 1 THEN 'invalid_event_version' END,
    CASE WHEN event_type IS NULL THEN 'missing_event_type' END,
    CASE WHEN event_type NOT IN ('order_created','order_updated','order_completed','order_cancelled')
      THEN 'invalid_event_type' END,
    CASE WHEN order_status IS NULL THEN 'missing_order_status' END,
    CASE WHEN order_status NOT IN ('pending','paid','processing','completed','cancelled')
      THEN 'invalid_order_status' END,
    CASE WHEN order_amount IS NULL THEN 'missing_order_amount' END,
    CASE WHEN order_amount <= 0 THEN 'non_positive_order_amount' END,
    CASE WHEN currency IS NULL THEN 'missing_currency' END,
    CASE WHEN NOT regexp_matches(currency, '^[A-Z]{{3}}$') THEN 'invalid_currency' END,
    CASE WHEN message_key IS NULL THEN 'missing_message_key' END,
    CASE WHEN message_key <> order_id THEN 'message_key_order_id_mismatch' END
  ) AS codes
  FROM bronze
),
silver AS (
  SELECT * FROM checked WHERE codes = ''
  QUALIFY row_number() OVER (
    PARTITION BY event_id ORDER BY kafka_timestamp, kafka_partition, kafka_offset) = 1
)"""
)

# Terms of the strict contract that the spoiled messages break.
_STRICT = (
    _MSG
    + """,
strict AS (
  SELECT *, CASE WHEN fault = 1 THEN 'invalid_payload' ELSE concat_ws(',',
    CASE WHEN event_id = 'not-a-uuid' THEN 'invalid_event_id' END,
    CASE WHEN event_type IS NULL THEN 'missing_event_type' END,
    CASE WHEN event_type = 'order_teleported' THEN 'invalid_event_type' END,
    CASE WHEN event_version < 1 THEN 'invalid_event_version' END,
    CASE WHEN order_id IS NULL THEN 'missing_order_id' END,
    CASE WHEN order_id = 'not-a-uuid' THEN 'invalid_order_id' END,
    CASE WHEN customer_id IS NULL THEN 'missing_customer_id' END,
    CASE WHEN customer_id = 'not-a-uuid' THEN 'invalid_customer_id' END,
    CASE WHEN order_status IS NULL THEN 'missing_order_status' END,
    CASE WHEN order_status = 'shipped' THEN 'invalid_order_status' END,
    CASE WHEN order_amount IS NULL THEN 'missing_order_amount' END,
    CASE WHEN order_amount <= 0 THEN 'non_positive_order_amount' END
  ) END AS codes
  FROM msg
)"""
)


def _metrics(source: str, name: str = "metrics") -> str:
    return f"""{name} AS (
  SELECT date_trunc('hour', event_time) AS window_start,
    date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
    currency,
    CAST(count(*) AS BIGINT) AS order_event_count,
    CAST(count(*) FILTER (event_type = 'order_created') AS BIGINT) AS created_order_count,
    CAST(count(*) FILTER (event_type = 'order_completed') AS BIGINT) AS completed_order_count,
    CAST(coalesce(sum(order_amount) FILTER (event_type = 'order_completed'), 0)
      AS DECIMAL(22,2)) AS revenue,
    CAST(avg(order_amount) FILTER (event_type = 'order_completed')
      AS DECIMAL(16,6)) AS average_order_value
  FROM {source} GROUP BY ALL
)"""


def _status(source: str, name: str = "status") -> str:
    return f"""{name} AS (
  SELECT date_trunc('hour', event_time) AS window_start,
    date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
    currency, order_status, CAST(count(*) AS BIGINT) AS status_event_count
  FROM {source} GROUP BY ALL
)"""


def _pivot(source: str) -> str:
    sums = ", ".join(
        f"CAST(sum(status_event_count) FILTER (order_status = '{status}') AS BIGINT) AS {column}"
        for status, column in _PIVOT.items()
    )
    return f"pivoted AS (SELECT window_start, currency, {sums} FROM {source} GROUP BY 1, 2)"


_PIVOT = {
    "pending": "pending_event_count",
    "paid": "paid_event_count",
    "processing": "processing_event_count",
    "completed": "completed_status_event_count",
    "cancelled": "cancelled_event_count",
}


def _mart(status_source: str = "status") -> str:
    counts = ", ".join(f"coalesce(p.{c}, 0) AS {c}" for c in _PIVOT.values())
    return f"""{_pivot(status_source)},
mart AS (
  SELECT m.*, {counts} FROM metrics m LEFT JOIN pivoted p
    ON m.window_start = p.window_start AND m.currency = p.currency
)"""


_GOLD = f"{_EV}, {_metrics('ev')}, {_status('ev')}"
_FULL_MART = f"{_GOLD}, {_mart()}"
_ZEROS = ", ".join(f"0 AS {column}" for column in _PIVOT.values())
#: An event as it was sent, with the defaults that do not depend on the clock.
_SENT = (
    "event_id, event_time, event_type, coalesce(event_version, 1) AS event_version, order_id, "
    "customer_id, order_status, order_amount, upper(coalesce(currency, 'USD')) AS currency"
)
_FINAL = (
    "window_end <= (SELECT date_trunc('millisecond', max(event_time)) FROM {src}) - INTERVAL 1 DAY"
)

# The broken tables of the data-quality queries.
_FAULTY = f"""{_FULL_MART},
bad_metrics1 AS (
  SELECT * REPLACE (
    CASE WHEN currency = 'EUR' THEN NULL ELSE revenue END AS revenue,
    CASE WHEN currency = 'USD' THEN window_start ELSE window_end END AS window_end)
  FROM metrics
),
bad_metrics AS (
  SELECT * FROM bad_metrics1 UNION ALL SELECT * FROM bad_metrics1 WHERE currency = 'TWD'
),
bad_status1 AS (
  SELECT * REPLACE (
    CASE WHEN order_status = 'paid' AND currency = 'EUR' THEN 'shipped'
      ELSE order_status END AS order_status)
  FROM status
),
bad_status AS (
  SELECT * FROM bad_status1 UNION ALL SELECT * FROM bad_status1 WHERE order_status = 'cancelled'
),
bad_mart1 AS (
  SELECT * REPLACE (
    CASE WHEN currency = 'EUR' THEN CAST(-1 AS DECIMAL(22,2)) ELSE revenue END AS revenue,
    CASE WHEN currency = 'USD' THEN paid_event_count + 1 ELSE paid_event_count END
      AS paid_event_count)
  FROM mart
),
bad_mart AS (
  SELECT * FROM bad_mart1 UNION ALL SELECT * FROM bad_mart1 WHERE currency = 'TWD'
)"""


def _variants(template: str) -> str:
    """The same select over clean and over broken tables."""
    clean = template.format(metrics="metrics", status="status", mart="mart", v="clean")
    faulty = template.format(
        metrics="bad_metrics", status="bad_status", mart="bad_mart", v="faulty"
    )
    return f"WITH {_FAULTY} {clean} UNION ALL {faulty}"


_NOT_NULL = [
    ("order_metrics_hourly", "{metrics}", "window_start"),
    ("order_metrics_hourly", "{metrics}", "window_end"),
    ("order_metrics_hourly", "{metrics}", "currency"),
    ("order_metrics_hourly", "{metrics}", "order_event_count"),
    ("order_metrics_hourly", "{metrics}", "revenue"),
    ("order_status_hourly", "{status}", "window_start"),
    ("order_status_hourly", "{status}", "currency"),
    ("order_status_hourly", "{status}", "order_status"),
    ("order_status_hourly", "{status}", "status_event_count"),
    ("stg_order_metrics_hourly", "{metrics}", "window_start"),
    ("stg_order_metrics_hourly", "{metrics}", "currency"),
    ("stg_order_status_hourly", "{status}", "window_start"),
    ("stg_order_status_hourly", "{status}", "currency"),
    ("stg_order_status_hourly", "{status}", "order_status"),
    ("fct_hourly_commerce_metrics", "{mart}", "window_start"),
    ("fct_hourly_commerce_metrics", "{mart}", "window_end"),
    ("fct_hourly_commerce_metrics", "{mart}", "currency"),
    ("fct_hourly_commerce_metrics", "{mart}", "order_event_count"),
    ("fct_hourly_commerce_metrics", "{mart}", "revenue"),
]
_STATUS_LIST = "('pending', 'paid', 'processing', 'completed', 'cancelled')"
_METRICS_DUPES = (
    "SELECT window_start, currency FROM {metrics} GROUP BY 1, 2 HAVING count(*) > 1"
)
_STATUS_DUPES = (
    "SELECT window_start, currency, order_status FROM {status} GROUP BY 1, 2, 3 HAVING count(*) > 1"
)
_NEGATIVE = " OR ".join(
    f"{c} < 0"
    for c in [
        "order_event_count",
        "created_order_count",
        "completed_order_count",
        "revenue",
        *_PIVOT.values(),
    ]
)
_UNRECONCILED = f"order_event_count <> {' + '.join(_PIVOT.values())}"
_FAILING_SETS = {
    "accepted_values_order_status_hourly_order_status": (
        f"SELECT 1 FROM {{status}} WHERE order_status NOT IN {_STATUS_LIST}"
    ),
    "source_grains_are_unique": (
        f"SELECT 1 FROM ({_METRICS_DUPES}) a UNION ALL SELECT 1 FROM ({_STATUS_DUPES}) b"
    ),
    "mart_grain_is_unique": (
        "SELECT window_start, currency FROM {mart} GROUP BY 1, 2 HAVING count(*) > 1"
    ),
    "metrics_are_non_negative": f"SELECT 1 FROM {{mart}} WHERE {_NEGATIVE}",
    "status_counts_reconcile": f"SELECT 1 FROM {{mart}} WHERE {_UNRECONCILED}",
}


def _suite() -> str:
    rows = [
        f"SELECT 'not_null_{dataset}_{column}' AS test_name, "
        f"CAST(count(*) FILTER ({column} IS NULL) AS BIGINT) AS failing_rows FROM {table}"
        for dataset, table, column in _NOT_NULL
    ] + [
        f"SELECT '{name}' AS test_name, CAST(count(*) AS BIGINT) AS failing_rows FROM ({sql}) t"
        for name, sql in _FAILING_SETS.items()
    ]
    union = " UNION ALL ".join(rows)
    return _variants(
        f"SELECT test_name, failing_rows, failing_rows = 0 AS passed, '{{v}}' AS variant "
        f"FROM ({union}) s"
    )


def _constraints() -> str:
    def row(dataset: str, table: str, name: str, bad: str) -> str:
        return (
            f"SELECT '{name}' AS constraint_name, "
            f"CAST(count(*) FILTER ({bad}) AS BIGINT) AS failing_rows, "
            f"'{dataset}' AS dataset FROM {table}"
        )

    def key(dataset: str, names: str, sql: str) -> str:
        return (
            f"SELECT 'unique {names}' AS constraint_name, CAST(count(*) AS BIGINT) AS failing_rows, "
            f"'{dataset}' AS dataset FROM ({sql}) k"
        )

    m, s = "order_metrics_hourly", "order_status_hourly"
    counts = ["order_event_count", "created_order_count", "completed_order_count", "revenue"]
    rows = [
        *[row(m, "{metrics}", f"{c} not null", f"{c} IS NULL") for c in
          ["window_start", "window_end", "currency", *counts]],
        row(m, "{metrics}", "window_end > window_start", "window_end <= window_start"),
        *[row(m, "{metrics}", f"{c} >= 0", f"{c} < 0") for c in counts],
        key(m, "window_start,currency", _METRICS_DUPES),
        *[row(s, "{status}", f"{c} not null", f"{c} IS NULL") for c in
          ["window_start", "window_end", "currency", "order_status", "status_event_count"]],
        row(s, "{status}", "window_end > window_start", "window_end <= window_start"),
        row(s, "{status}", "status_event_count >= 0", "status_event_count < 0"),
        key(s, "window_start,currency,order_status", _STATUS_DUPES),
        row(m, "{metrics}", "loaded_at not null", "'{v}' = 'faulty' AND currency = 'EUR'"),
        row("order_events", "ev", "raw_event not null", "'{v}' = 'faulty' AND order_status = 'paid'"),
        key("order_events", "event_id", "SELECT 1 FROM ev WHERE '{v}' = 'faulty' AND order_status = 'pending'"),
    ]
    union = " UNION ALL ".join(rows)
    return _variants(f"SELECT *, '{{v}}' AS variant FROM ({union}) c WHERE failing_rows > 0")


_METRIC_COLUMNS = (
    "window_start, window_end, currency, order_event_count, created_order_count, "
    "completed_order_count, revenue, average_order_value"
)
_STATUS_COLUMNS = "window_start, window_end, currency, order_status, status_event_count"
_EVENT_COLUMNS = (
    "event_id, event_type, event_version, order_id, customer_id, order_status, order_amount, "
    "currency, event_time"
)
_POSITION = "kafka_topic, kafka_partition, kafka_offset, kafka_timestamp"


def _arrivals(later: str, from_first: str) -> str:
    """Final windows of a stream that gets all events twice, ``later`` apart.

    Windows closed after the first arrival hold only the first copies; of the
    second ones, those for a closed window are lost.
    """
    return f"""WITH {_EV},
closed AS (
  SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 1 DAY AS w1,
    date_trunc('millisecond', max(event_time) + {later}) - INTERVAL 1 DAY AS w2 FROM ev
),
arrived AS (
  SELECT 1 AS round, * FROM ev
  UNION ALL SELECT 2 AS round, * REPLACE (event_time + {later} AS event_time) FROM ev
),
kept AS (
  SELECT a.* FROM arrived a, closed
  WHERE round = 1 OR date_trunc('hour', event_time) + INTERVAL 1 HOUR > {from_first}
),
{_metrics('kept')}
SELECT window_start, currency, order_event_count, revenue FROM metrics, closed
WHERE window_end <= w2"""


ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_parquet": f"WITH {_EV} SELECT {_EVENT_COLUMNS}, message_key, {_POSITION} FROM ev",
    "stream_parquet_source": (
        f"WITH {_EV} SELECT {_EVENT_COLUMNS}, CAST(event_time AS DATE) AS event_date FROM ev"
    ),
    "stream_partitioned_sink": f"""WITH {_MSG}
      SELECT CAST(kafka_timestamp AS DATE) AS sent_date, CAST(count(*) AS BIGINT) AS messages,
        CAST(count(*) FILTER (is_valid_json) AS BIGINT) AS json_messages,
        CAST(sum(order_amount) AS DECIMAL(22,2)) AS amount
      FROM bronze GROUP BY 1""",
    "scan_pruned_gold": f"""WITH {_GOLD} SELECT window_start, currency, revenue FROM metrics
      WHERE window_start >= TIMESTAMP '2024-01-10 00:00:00'""",
    "upsert_metrics": f"""WITH {_GOLD} SELECT * REPLACE (
        CASE WHEN currency = 'USD' THEN order_event_count ELSE order_event_count + 1000 END
        AS order_event_count) FROM metrics""",
    "upsert_status": f"""WITH {_GOLD} SELECT * REPLACE (
        CASE WHEN order_status = 'pending' THEN status_event_count
        ELSE status_event_count + 1000 END AS status_event_count) FROM status""",
    "insert_if_absent": f"""WITH {_EV} SELECT event_id, order_id, order_status,
        CAST(CASE WHEN currency = 'USD' THEN order_amount ELSE order_amount + 1 END
          AS DECIMAL(12,2)) AS order_amount, event_time FROM ev""",
    "recent_store_events": f"""WITH {_EV} SELECT event_id, event_type, order_status, order_amount,
        event_time FROM ev ORDER BY event_id LIMIT 10""",
    "publish_envelope": f"""WITH {_EV} SELECT order_id AS key,
        '{{"event_id":"' || event_id || '","event_type":"' || event_type || '","event_version":1'
        || ',"order_id":"' || order_id || '","customer_id":"' || customer_id
        || '","order_status":"' || order_status || '","order_amount":"'
        || CAST(order_amount AS VARCHAR) || '","currency":"' || currency || '","event_time":"'
        || strftime(event_time, '%Y-%m-%dT%H:%M:%S')
        || CASE WHEN strftime(event_time, '%f') = '000000' THEN ''
           ELSE '.' || strftime(event_time, '%f') END || 'Z"}}' AS value
      FROM ev""",
    "event_store_stream": f"""WITH {_STRICT}, stored AS (
        SELECT * FROM strict WHERE codes = ''
        QUALIFY event_id IS NULL OR row_number() OVER (PARTITION BY event_id ORDER BY kafka_offset) = 1)
      SELECT {_SENT} FROM stored""",
    "event_store_mixed_writers": f"""WITH {_STRICT}, stored AS (
        SELECT * FROM strict WHERE codes = ''
        QUALIFY event_id IS NULL OR row_number() OVER (PARTITION BY event_id ORDER BY kafka_offset) = 1)
      SELECT {_SENT}, true AS counts_add_up, CAST(0 AS BIGINT) AS inserted_again FROM stored""",
    "event_store_outcome": f"""WITH {_STRICT}, stored AS (
        SELECT * FROM strict WHERE codes = ''
        QUALIFY event_id IS NULL OR row_number() OVER (PARTITION BY event_id ORDER BY kafka_offset) = 1)
      SELECT code AS outcome, CAST(count(*) AS BIGINT) AS messages
      FROM (SELECT unnest(string_split(codes, ',')) AS code FROM strict WHERE codes <> '') c GROUP BY 1
      UNION ALL SELECT 'stored', CAST(count(*) AS BIGINT) FROM stored""",
    "stored_count": f"""WITH {_EV} SELECT CAST(count(*) AS BIGINT) AS stored_count FROM ev
      WHERE event_id = '00000000-0000-4000-8000-000000000100'""",
    "poison_tolerance": f"""WITH {_STRICT}, stored AS (
        SELECT *, coalesce(event_id, CAST(kafka_partition AS VARCHAR) || '/' || CAST(kafka_offset AS VARCHAR)) AS ident
        FROM strict WHERE codes = '' AND kafka_offset % 40 <> 21)
      SELECT order_status, event_type, CAST(count(DISTINCT ident) AS BIGINT) AS stored,
        CAST(count(DISTINCT ident) AS BIGINT) AS ids
      FROM stored GROUP BY 1, 2""",
    "materialize_mart": f"WITH {_FULL_MART} SELECT * FROM mart",
    "table_row_counts": f"""WITH {_FULL_MART}
      SELECT 'reporting_order_metrics_hourly' AS dataset, CAST(count(*) AS BIGINT) AS row_count FROM metrics
      UNION ALL SELECT 'reporting_stg_order_metrics_hourly', CAST(count(*) AS BIGINT) FROM metrics
      UNION ALL SELECT 'reporting_order_status_hourly', CAST(count(*) AS BIGINT) FROM status
      UNION ALL SELECT 'reporting_stg_order_status_hourly', CAST(count(*) AS BIGINT) FROM status
      UNION ALL SELECT 'reporting_fct_hourly_commerce_metrics', CAST(count(*) AS BIGINT) FROM mart""",
    "table_row_counts_of_database": f"""WITH {_FULL_MART}
      SELECT 'order_metrics_hourly' AS dataset, CAST(count(*) AS BIGINT) AS row_count FROM metrics
      UNION ALL SELECT 'stg_order_metrics_hourly', CAST(count(*) AS BIGINT) FROM metrics
      UNION ALL SELECT 'order_status_hourly', CAST(count(*) AS BIGINT) FROM status
      UNION ALL SELECT 'stg_order_status_hourly', CAST(count(*) AS BIGINT) FROM status
      UNION ALL SELECT 'fct_hourly_commerce_metrics', CAST(count(*) AS BIGINT) FROM mart""",
    # projections and parsing
    "bronze_envelope": f"WITH {_MSG} SELECT message_key, raw_event, {_POSITION} FROM bronze",
    "json_validity": f"WITH {_MSG} SELECT kafka_partition, kafka_offset, is_valid_json FROM bronze",
    "bronze_parse": f"WITH {_MSG} SELECT kafka_partition, kafka_offset, {_EVENT_COLUMNS} FROM bronze",
    "silver_events": f"""WITH {_CHECKED} SELECT {_EVENT_COLUMNS}, message_key, {_POSITION},
        CAST(event_time AS DATE) AS event_date FROM silver""",
    "quarantine_events": f"""WITH {_CHECKED} SELECT raw_event, codes AS validation_errors,
        message_key, {_POSITION} FROM checked WHERE codes <> ''""",
    "valid_invalid_split": f"""WITH {_CHECKED} SELECT codes = '' AS is_valid,
        CAST(count(*) AS BIGINT) AS messages FROM checked GROUP BY 1""",
    "stg_metrics": f"WITH {_GOLD} SELECT {_METRIC_COLUMNS} FROM metrics",
    "stg_status": f"WITH {_GOLD} SELECT {_STATUS_COLUMNS} FROM status",
    "utc_normalize": """SELECT event_id, ts AS assumed_utc, ts - INTERVAL 8 HOUR AS from_taipei
      FROM events""",
    "contract_normalize": f"WITH {_EV} SELECT {_EVENT_COLUMNS} FROM ev",
    "status_to_event_type": f"WITH {_EV} SELECT event_id, order_status, event_type FROM ev",
    "lifecycle_expand": """WITH steps(step, order_status, event_type, cancelled) AS (VALUES
        (0, 'pending', 'order_created', true), (1, 'cancelled', 'order_cancelled', true),
        (0, 'pending', 'order_created', false), (1, 'paid', 'order_updated', false),
        (2, 'processing', 'order_updated', false), (3, 'completed', 'order_completed', false))
      SELECT '10000000-0000-4000-8000-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_id,
        '20000000-0000-4000-8000-' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS customer_id,
        CAST(o_totalprice AS DECIMAL(12,2)) AS order_amount,
        CAST(step AS INTEGER) AS step, order_status, event_type,
        o_orderdate + CAST(step AS INTEGER) * INTERVAL 5 MINUTE AS event_time
      FROM orders JOIN steps ON cancelled = (o_orderstatus = 'P')""",
    # validation
    "validation_errors": f"""WITH {_CHECKED} SELECT kafka_partition, kafka_offset,
        codes AS validation_errors, codes = '' AS is_valid FROM checked""",
    "validation_error_counts": f"""WITH {_CHECKED} SELECT code, CAST(count(*) AS BIGINT) AS messages
      FROM (SELECT unnest(string_split(codes, ',')) AS code FROM checked WHERE codes <> '') c
      GROUP BY 1""",
    "strict_contract": f"""WITH {_STRICT} SELECT kafka_partition, kafka_offset,
        CASE fault WHEN 22 THEN 'order_amount_too_many_digits' WHEN 23 THEN 'invalid_currency'
          WHEN 24 THEN 'event_time_without_zone' ELSE codes END AS contract_errors FROM strict""",
    # aggregates and joins
    "gold_order_metrics": f"""WITH {_GOLD} SELECT {_METRIC_COLUMNS},
        CAST(window_start AS DATE) AS window_date FROM metrics""",
    "gold_status_distribution": f"""WITH {_GOLD} SELECT {_STATUS_COLUMNS},
        CAST(window_start AS DATE) AS window_date FROM status""",
    "status_pivot": f"WITH {_GOLD}, {_pivot('status')} SELECT * FROM pivoted",
    "mart_hourly": f"""WITH {_FULL_MART} SELECT * FROM mart
      UNION ALL SELECT * REPLACE (window_start + INTERVAL 1000 DAY AS window_start,
        window_end + INTERVAL 1000 DAY AS window_end, {_ZEROS}) FROM mart""",
    "duplicate_event_ids": f"""WITH {_CHECKED} SELECT CAST(count(*) AS BIGINT) AS duplicate_count
      FROM (SELECT event_id FROM checked WHERE codes = '' GROUP BY 1 HAVING count(*) > 1) d""",
    "row_counts": f"""WITH {_CHECKED}, {_metrics('ev')}, {_status('ev')}
      SELECT 'bronze' AS dataset, CAST(count(*) AS BIGINT) AS row_count FROM bronze
      UNION ALL SELECT 'silver', CAST(count(*) AS BIGINT) FROM silver
      UNION ALL SELECT 'quarantine', CAST(count(*) AS BIGINT) FROM checked WHERE codes <> ''
      UNION ALL SELECT 'gold_metrics', CAST(count(*) AS BIGINT) FROM metrics
      UNION ALL SELECT 'gold_status', CAST(count(*) AS BIGINT) FROM status""",
    "mart_grain_counts": f"""WITH {_FULL_MART} SELECT CAST(count(*) AS BIGINT) AS row_count,
        CAST(count(DISTINCT (window_start, currency)) AS BIGINT) AS unique_grains FROM mart""",
    # reports
    "latest_silver": f"""WITH {_CHECKED} SELECT event_id, event_type, order_status, order_amount,
        currency, event_time, CAST(event_time AS DATE) AS event_date
      FROM silver ORDER BY event_time DESC, event_id LIMIT 20""",
    "latest_metrics": f"""WITH {_GOLD} SELECT {_METRIC_COLUMNS},
        CAST(window_start AS DATE) AS window_date
      FROM metrics ORDER BY window_start DESC, currency LIMIT 20""",
    "latest_status": f"""WITH {_GOLD} SELECT {_STATUS_COLUMNS},
        CAST(window_start AS DATE) AS window_date
      FROM status ORDER BY window_start DESC, order_status, currency LIMIT 20""",
    "recent_metrics": f"""WITH {_GOLD} SELECT window_start, currency, created_order_count,
        completed_order_count, revenue, average_order_value
      FROM metrics ORDER BY window_start DESC, currency LIMIT 10""",
    "preview_bronze": f"""WITH {_MSG} SELECT event_id, event_type, order_status, order_amount,
        kafka_partition, kafka_offset, is_valid_json
      FROM bronze ORDER BY kafka_partition, kafka_offset LIMIT 20""",
    "preview_quarantine": f"""WITH {_CHECKED} SELECT codes AS validation_errors, raw_event,
        kafka_partition, kafka_offset FROM checked WHERE codes <> ''
      ORDER BY kafka_partition, kafka_offset LIMIT 20""",
    # deduplication and streams
    "dedup_batch": f"WITH {_EV} SELECT event_id, event_time, {_POSITION} FROM ev",
    "dedup_within_watermark": f"""WITH {_EV} SELECT event_id, order_id, event_time,
        CAST(event_time AS DATE) AS event_date FROM ev""",
    "stream_several_files": f"""WITH {_EV} SELECT event_id, event_time,
        CAST(3 AS INTEGER) AS micro_batches FROM ev""",
    "stream_gold_order_metrics": f"""WITH {_GOLD} SELECT {_METRIC_COLUMNS} FROM metrics
      WHERE {_FINAL.format(src='ev')}""",
    "stream_gold_status": f"""WITH {_GOLD} SELECT {_STATUS_COLUMNS} FROM status
      WHERE {_FINAL.format(src='ev')}""",
    "late_rows": _arrivals("INTERVAL 12 HOUR", "w1"),
    "checkpoint_resume": _arrivals("INTERVAL 60 DAY", "w1"),
    "stream_silver_split": f"""WITH {_CHECKED}
      SELECT 'silver' AS branch, event_id AS ident, '' AS validation_errors FROM silver
      UNION ALL
      SELECT 'quarantine', CAST(kafka_partition AS VARCHAR) || ':' || CAST(kafka_offset AS VARCHAR),
        codes FROM checked WHERE codes <> ''""",
    # data quality
    "dq_not_null": _variants(
        " UNION ALL ".join(
            f"SELECT '{dataset}' AS dataset, '{column}' AS column_name, "
            f"CAST(count(*) FILTER ({column} IS NULL) AS BIGINT) AS failing_rows, "
            f"'{{v}}' AS variant FROM {table}"
            for dataset, table, column in _NOT_NULL
        )
    ),
    "dq_accepted_values": _variants(
        f"SELECT {_STATUS_COLUMNS}, '{{v}}' AS variant FROM {{status}} "
        f"WHERE order_status NOT IN {_STATUS_LIST}"
    ),
    "grain_violations": _variants(
        f"SELECT 'order_metrics_hourly' AS source_name, '{{v}}' AS variant "
        f"FROM ({_METRICS_DUPES}) a UNION ALL "
        f"SELECT 'order_status_hourly', '{{v}}' FROM ({_STATUS_DUPES}) b"
    ),
    "dq_unique_grain": _variants(
        "SELECT window_start, currency, '{v}' AS variant FROM {mart} "
        "GROUP BY 1, 2 HAVING count(*) > 1"
    ),
    "dq_non_negative": _variants(f"SELECT *, '{{v}}' AS variant FROM {{mart}} WHERE {_NEGATIVE}"),
    "dq_reconcile": _variants(f"SELECT *, '{{v}}' AS variant FROM {{mart}} WHERE {_UNRECONCILED}"),
    "dq_constraints": _constraints(),
    "dq_suite": _suite(),
    # pipelines
    "refresh_marts": f"WITH {_FULL_MART} SELECT * FROM mart",
    "lake_end_to_end": f"""WITH {_CHECKED}, {_metrics('silver', 'all_metrics')},
      {_status('silver', 'all_status')},
      metrics AS (SELECT * FROM all_metrics WHERE {_FINAL.format(src='silver')}),
      status AS (SELECT * FROM all_status WHERE {_FINAL.format(src='silver')}),
      {_mart()} SELECT * FROM mart""",
    "lake_batch": f"""WITH {_CHECKED}, {_metrics('silver')} SELECT {_METRIC_COLUMNS},
        CAST(window_start AS DATE) AS window_date FROM metrics""",
    "lake_backfill_then_stream": f"""WITH {_CHECKED},
      {_metrics('silver', 'whole')},
      built AS (SELECT * FROM silver WHERE kafka_partition IN (0, 1)), {_metrics('built', 'early')},
      final AS (SELECT * FROM whole WHERE {_FINAL.format(src='silver')}),
      gold AS (SELECT * FROM final UNION ALL SELECT * FROM early
        WHERE (window_start, currency) NOT IN (SELECT (window_start, currency) FROM final))
      SELECT 'silver' AS dataset, event_id, event_time, currency, order_amount FROM silver
      UNION ALL SELECT 'gold', NULL, window_start, currency,
        CAST(order_event_count AS DECIMAL(12,2)) FROM gold""",
}
