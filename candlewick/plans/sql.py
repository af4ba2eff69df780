"""Shared fragments of the SQL twins: the same inputs as in ``fixtures``."""

TICKS = """ticks AS (
  SELECT event_type AS symbol, ts, event_id AS seq, value AS price, CAST(json_extract_string(props, '$.k') AS BIGINT) AS size
  FROM events)"""

HOURLY = TICKS + """, bars AS (
  SELECT symbol, time_bucket(INTERVAL 1 HOUR, ts) AS ts, arg_min(price, ts) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, ts) AS close, CAST(sum(size) AS BIGINT) AS volume
  FROM ticks t GROUP BY symbol, time_bucket(INTERVAL 1 HOUR, t.ts))"""

TRADES = """trades AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS ts, l_orderkey * 16 + l_linenumber AS seq,
         l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS size
  FROM lineitem)"""

DAILY = TRADES + """, bars AS (
  SELECT symbol, ts, arg_min(price, seq) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, seq) AS close, CAST(sum(size) AS BIGINT) AS volume
  FROM trades GROUP BY symbol, ts)"""

MINUTE = """minute AS (
  SELECT event_type AS symbol, ts AS "timestamp", event_id AS seq,
         CAST(value AS DECIMAL(18,2)) AS open, CAST(value + k / 100 AS DECIMAL(18,2)) AS high,
         CAST(value - (k % 7) / 100 AS DECIMAL(18,2)) AS low, CAST(value + (k * 3 % 11 - 5) / 100 AS DECIMAL(18,2)) AS close, k AS volume,
         CAST(value + (k * 3 % 11 - 5) / 100 AS DECIMAL(18,2)) AS adjusted_close
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""

RETURNS = """rets AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn,
         close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret
  FROM bars)"""

NUMBERED = """nb AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM bars)"""


def with_(*parts: str) -> str:
    """WITH clause from fragments; the last part is the SELECT."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def ewm(x: str, alpha: float, order: str = "rn", part: str = "symbol") -> str:
    """Recurrence y = alpha * x + (1 - alpha) * y over all earlier non-null values."""
    return (
        f"CASE WHEN ({x}) IS NOT NULL THEN list_reduce(list({x}) FILTER (WHERE ({x}) IS NOT NULL) "
        f"OVER (PARTITION BY {part} ORDER BY {order} ROWS UNBOUNDED PRECEDING), "
        f"lambda a, b: {1 - alpha!r} * a + {alpha!r} * b) END"
    )
