"""Table schemas.

Ids and counts are BIGINT and metrics DOUBLE, so ids cannot overflow on large
corpora and averages are taken over unrounded values.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in columns])


VIDEOS = _schema(
    ("video_id", T.StringType(), False),
    ("url", T.StringType(), False),
    ("title", T.StringType(), True),
    ("processed_at", T.TimestampType(), False),
)

SEGMENTS = _schema(
    ("segment_id", T.LongType(), False),
    ("video_id", T.StringType(), False),
    ("start_time", T.DoubleType(), False),
    ("end_time", T.DoubleType(), False),
    ("text", T.StringType(), True),
    ("topic_label", T.StringType(), True),
    ("ext_summary", T.StringType(), True),
    ("abs_summary", T.StringType(), True),
    ("textrank_score", T.DoubleType(), True),
    ("compression_ratio", T.DoubleType(), True),
    ("semantic_similarity", T.DoubleType(), True),
)

ENTITIES = _schema(
    ("entity_id", T.LongType(), False),
    ("segment_id", T.LongType(), False),
    ("video_id", T.StringType(), False),
    ("entity_text", T.StringType(), False),
    ("entity_type", T.StringType(), False),
)

CO_OCCURRENCES = _schema(
    ("entity_a", T.StringType(), False),
    ("entity_b", T.StringType(), False),
    ("video_count", T.LongType(), False),
    ("segment_count", T.LongType(), False),
)

#: Videos that a batch could not process, with the reason.
FAILURES = _schema(
    ("video_id", T.StringType(), False),
    ("error", T.StringType(), False),
    ("failed_at", T.TimestampType(), False),
)

GRAPH_NODES = _schema(
    ("entity_text", T.StringType(), False),
    ("entity_type", T.StringType(), True),
)

GRAPH_EDGES = CO_OCCURRENCES

TABLES: dict[str, T.StructType] = {
    "videos": VIDEOS,
    "segments": SEGMENTS,
    "entities": ENTITIES,
    "co_occurrences": CO_OCCURRENCES,
    "failures": FAILURES,
}

#: A segment is identified by its video and its id inside the corpus.
SEGMENT_KEYS = ("video_id", "segment_id")
