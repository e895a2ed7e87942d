"""Queries on intervals per recording."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spoolwright.operators import intervals as iv
from spoolwright.session import table

KEYS = ["track", "audio_path"]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged periods and gaps of each recording, for both tables of detections."""
    spans = iv.detected_spans(table(spark, sf_dir, "audio_segments"), table(spark, sf_dir, "speech_segments"))
    return iv.merged_and_gaps(spans, KEYS)


def p2_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every continuous period with the number of detections in it."""
    spans = iv.detected_spans(table(spark, sf_dir, "audio_segments"), table(spark, sf_dir, "speech_segments"))
    return iv.periods(spans, KEYS)


_PERIODS = """WITH v AS (
    SELECT track, audio_path, CAST(round(start_time * 1000) AS BIGINT) AS s, CAST(round(end_time * 1000) AS BIGINT) AS e FROM (
        SELECT 'audio' AS track, audio_path, start_time, end_time FROM audio_segments
        UNION ALL SELECT 'speech', audio_path, start_time, end_time FROM speech_segments)
    WHERE NOT isnan(start_time) AND NOT isnan(end_time) AND end_time > start_time),
w AS (SELECT *, max(e) OVER (PARTITION BY track, audio_path ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM v WHERE e > s),
g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe THEN 1 ELSE 0 END) OVER (PARTITION BY track, audio_path ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM w),
p AS (SELECT track, audio_path, min(s) AS start_ms, max(e) AS end_ms, count(*) AS n FROM g GROUP BY track, audio_path, i)
"""

QUERIES = {"p2_found": p2_found, "p2_periods": p2_periods}
ORACLES = {
    "p2_found": _PERIODS
    + """SELECT track, audio_path, 'merged' AS kind, start_ms, end_ms FROM p WHERE n >= 2
UNION ALL SELECT * FROM (SELECT track, audio_path, 'gap' AS kind, end_ms AS start_ms, lead(start_ms) OVER (PARTITION BY track, audio_path ORDER BY start_ms) AS end_ms FROM p) WHERE end_ms IS NOT NULL""",
    "p2_periods": _PERIODS + "SELECT track, audio_path, start_ms, end_ms, n FROM p",
}
