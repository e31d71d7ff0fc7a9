"""Hand-made payloads for the edge cases."""

import datetime
import json

from jsonmart.plans.staging import stage

RAW_SCHEMA = "resource STRING, payload STRING, source_key STRING, extracted_at TIMESTAMP"


def day(n):
    return datetime.datetime(2024, 1, n)


def raw(spark, rows):
    """Rows of (resource, payload as dict or text, day, source key)."""
    data = []
    for i, (resource, payload, *rest) in enumerate(rows):
        text = payload if isinstance(payload, str) else json.dumps(payload)
        data.append((resource, text, rest[1] if len(rest) > 1 else f"k{i}", day(rest[0] if rest else 1)))
    return spark.createDataFrame(data, RAW_SCHEMA)


def staged(spark, resource, *payloads):
    """Staged rows from payloads or (payload, day, source key) tuples."""
    rows = [(resource, *p) if isinstance(p, tuple) else (resource, p) for p in payloads]
    return stage(raw(spark, rows), resource)


def tuples(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())
