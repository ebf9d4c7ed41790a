"""Windows over the event table, run as a batch."""

from __future__ import annotations

from ..streaming import windows as S
from ..tables import load

QUERIES = {
    "event_windows": lambda s, d: S.counted(load(s, d, "events")),
    "event_sliding": lambda s, d: S.counted(load(s, d, "events"), length="1 hour", slide="30 minutes"),
    "event_sessions": lambda s, d: S.sessions(load(s, d, "events")),
}
ORACLE = {
    "event_windows": "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE ts IS NOT NULL GROUP BY ALL",
    "event_sliding": "SELECT time_bucket(INTERVAL '30 minutes', ts) - k * INTERVAL '30 minutes' AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events, (VALUES (0), (1)) o(k) WHERE ts IS NOT NULL GROUP BY ALL",
    "event_sessions": "WITH a AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL '30 minutes' THEN 1 ELSE 0 END AS b FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)), c AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM a) SELECT min(ts) AS start, user_id, count(*) AS n FROM c GROUP BY user_id, g",
}
