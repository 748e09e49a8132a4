"""The hand-checked case: seven small inputs and the ten rows they must give."""

from __future__ import annotations

from datetime import date

from daymark.sources import SCHEMAS, Tables, conform


def day(text):
    return date.fromisoformat(text)


THE_WIRE_1 = ("T1", "the wire", "A", 1, "series", "drama", day("2024-01-01"))

INPUTS = {
    "entity_base": [
        THE_WIRE_1,
        THE_WIRE_1,
        ("T1", "the wire", "A", 2, "series", "drama", day("2024-06-01")),
        ("T2", "big FILM", "B", 0, "movie", "action", day("2024-03-01")),
        ("T3", "no season", "C", None, "series", "comedy", day("2024-04-01")),
        ("T4", "null movie", "C", None, "movie", "comedy", None),
    ],
    "active_snapshot": [("T1-1", 11.0, 28), ("T1-1", 99.0, 27), ("T2", 12.0, 28)],
    "funnel_metrics": [("T1-1", 0.25, 28), ("T1-2", 0.75, 7)],
    "active_forecast": [
        ("T1-1", "the wire S1", 50.0, "Post-Launch", 28, 28),
        ("T1-2", "the wire S2", 20.0, "Post-Launch", 28, 10),
        ("T1-2", "the wire S2", 21.0, "Post-Launch", 28, 28),
        ("T1-2", "the wire S2", 22.0, "Post-Launch", 28, 29),
        ("T1-2", "the wire S2", 23.0, "Post-Launch", 90, 28),
        ("F1", "new show S1", 31.0, "Pre-Launch", 28, -5),
        ("F1", "new show S1", 32.0, "Post-Greenlight", 28, 0),
        ("F1", "new show S1", 33.0, "Pre-Launch", 28, 1),
        ("F2", "lone film", 34.0, "Pre-Launch", 28, -1),
        ("F2", "lone film", 35.0, None, 28, 0),
    ],
    "view_forecast": [
        (*row, None)
        for row in [
            ("T1-1", "the wire S1", 60.0, "Post-Launch", 28, 28),
            ("T1-2", "the wire S2", 61.0, "Post-Launch", 28, 28),
            ("T4", "null movie", 62.0, "Post-Launch", 28, 5),
            ("F1a", "new show S1", 41.0, "Pre-Launch", 28, 5),
            ("F1b", "new show S1", 42.0, "Pre-Launch", 28, -5),
            (None, "lone film", 43.0, "Pre-Launch", 28, -2),
            (None, "other", 44.0, "Pre-Launch", 28, -1),
        ]
    ],
    "daily_forecast": [
        ("T1", "the wire", 1, 1, 100.0, "past"),
        ("T1", "the wire", 1, 1, 50.0, "past"),
        ("T1", "the wire", 1, 1, 7.0, "alpha"),
        ("T1", "the wire", 2, 1, 30.0, "past"),
        ("T1", "the wire", 2, 0, 40.0, "past"),
        ("T4", "null movie", None, 1, 9.0, "past"),
    ],
    "future_forecast": [
        ("new show", 1, day("2025-01-01"), "A", "series", "drama", 10.0, "alpha"),
        ("new show", 1, day("2025-01-01"), "A", "series", "drama", 5.0, "alpha"),
        ("new show", 1, day("2025-01-01"), "A", "series", "drama", 1.0, "beta"),
        ("lone film", 0, day("2025-02-01"), "B", "movie", "action", 20.0, "alpha"),
        ("quiet one", None, None, "C", "movie", "drama", None, "alpha"),
    ],
}

EXPECTED = {
    ("T1", "T1-1", "The Wire", "the wire S1", day("2024-01-01"), "A", 1, "drama", "series", 11.0, 25.0, 150.0, "actual", "actual"),
    ("T2", "T2", "Big Film", "big FILM", day("2024-03-01"), "B", 0, "action", "movie", 12.0, None, None, None, None),
    ("T3", None, "No Season", "no season", day("2024-04-01"), "C", None, "comedy", "series", None, None, None, None, None),
    ("T1", "T1-2", "The Wire", "the wire S2", day("2024-06-01"), "A", 2, "drama", "series", 21.0, 61.0, 30.0, "postlaunch", "actual"),
    ("T1", "T1-2", "The Wire", "the wire S2", day("2024-06-01"), "A", 2, "drama", "series", 21.0, 61.0, 40.0, "postlaunch", "postlaunch"),
    (None, None, "New Show", "new show S1", day("2025-01-01"), "A", 1, "drama", "series", 32.0, 41.0, 15.0, "postgreenlight", "postgreenlight"),
    (None, None, "New Show", "new show S1", day("2025-01-01"), "A", 1, "drama", "series", 32.0, 42.0, 15.0, "postgreenlight", "postgreenlight"),
    (None, None, "Lone Film", "lone film", day("2025-02-01"), "B", 0, "action", "movie", 34.0, None, 20.0, "prelaunch", "postgreenlight"),
    ("T4", "T4", "Null Movie", "null movie", None, "C", None, "comedy", "movie", None, 62.0, None, "postlaunch", None),
    (None, None, "Quiet One", "quiet one", None, "C", None, "drama", "movie", None, None, None, None, "postgreenlight"),
}


def write_inputs(spark, root, inputs=INPUTS, files=1):
    """Inputs as Parquet, so that plans look as they do on stored tables."""
    for name, rows in inputs.items():
        spark.createDataFrame(rows, SCHEMAS[name]).repartition(files).write.parquet(f"{root}/{name}")


def in_memory(spark, inputs=INPUTS):
    return Tables(**{name: conform(spark.createDataFrame(rows, SCHEMAS[name]), name) for name, rows in inputs.items()})
