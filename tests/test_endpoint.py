"""The endpoint on the hand-checked case, and properties it keeps on any input."""

from __future__ import annotations

import random
from datetime import date

import pytest

from daymark.operators import union_distinct
from daymark.plans import build_endpoint, future, launched
from daymark.plans.endpoint import result_columns
from daymark.sources import RESULT_SCHEMA, SCHEMAS, conform, from_catalog, from_parquet
from tests import golden
from tests.plans import settings


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("golden") / "inputs")
    golden.write_inputs(spark, root)
    return root


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def test_golden_rows(spark, stored):
    result = build_endpoint(from_parquet(spark, stored))
    rows = rows_of(result)
    assert len(rows) == len(golden.EXPECTED)
    assert set(rows) == golden.EXPECTED
    assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in RESULT_SCHEMA]


def test_golden_rows_without_broadcasts(spark, stored):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        rows = rows_of(build_endpoint(from_parquet(spark, stored)))
    assert len(rows) == len(golden.EXPECTED)
    assert set(rows) == golden.EXPECTED


def test_golden_rows_from_catalog(spark, stored):
    for name in SCHEMAS:
        spark.read.parquet(f"{stored}/{name}").createOrReplaceTempView(f"golden_{name}")
    tables = from_catalog(spark, {name: f"golden_{name}" for name in SCHEMAS})
    assert set(rows_of(build_endpoint(tables))) == golden.EXPECTED


def test_row_order_of_inputs_does_not_matter(spark):
    shuffled = {name: random.Random(7).sample(rows, len(rows)) for name, rows in golden.INPUTS.items()}
    assert set(rows_of(build_endpoint(golden.in_memory(spark, shuffled)))) == golden.EXPECTED


def test_numeric_ids_are_read_as_strings(spark):
    numeric = "title_id bigint, title_name string, tier string, season_number bigint, content_category string, " \
              "category string, effective_start_date date"
    raw = spark.createDataFrame([(5, "a", "A", 1, "series", "x", None), (6, "b", "A", 0, "movie", "x", None)], numeric)
    tables = golden.in_memory(spark)
    tables = type(tables)(**{**tables.__dict__, "entity_base": conform(raw, "entity_base")})
    keys = {row["match_id"] for row in launched(tables).collect()}
    assert keys == {"5-1", "6"}


def test_other_horizon_renames_columns(spark):
    result = build_endpoint(golden.in_memory(spark), horizon=7)
    assert result.columns == result_columns(7)
    assert "viewpct_retail_7d" in result.columns
    measured = {row["match_id"]: row["viewpct_retail_7d"] for row in result.where("match_id = 'T1-2'").collect()}
    assert measured == {"T1-2": 75.0}
    with pytest.raises(ValueError):
        build_endpoint(golden.in_memory(spark), horizon=90)


def test_title_delimiters_change_the_display_name_only(spark):
    inputs = dict(golden.INPUTS)
    inputs["entity_base"] = [("T9", "spider-man: the MOVIE", "A", 0, "movie", "x", None)]
    plain = launched(golden.in_memory(spark, inputs)).first()
    at_blanks = launched(golden.in_memory(spark, inputs), title_delimiters=None).first()
    assert (plain["title_name"], at_blanks["title_name"]) == ("Spider-Man: The Movie", "Spider-man: The Movie")
    assert plain["title_name_season"] == at_blanks["title_name_season"] == "spider-man: the MOVIE"


# --- random inputs against a plain restatement --------------------------------------------------------------------


def random_inputs(seed):
    """Inputs with few distinct values, hence with many copies, ties, NULLs and heavy keys."""
    rng = random.Random(seed)

    def maybe(value, share=0.15):
        return None if rng.random() < share else value

    def hot(values):
        return values[0] if rng.random() < 0.35 else rng.choice(values)

    titles, seasons, ids = ["ab", "c d", "ab S1", "Ab"], [0, 1, 2, None], ["1", "2", "3", "4", "5"]
    keys = ["1-1", "1", "2", "2-1", "3", "4-2", "5"]
    names = ["ab", "c d", "ab S1", "ab S1 S1", "ab S2", "Ab", "c d S1"]
    days = [date(2024, 1, 1), date(2024, 2, 1)]
    phases = ["Post-Launch", "Pre-Launch", "Post-Greenlight"]

    def forecast():
        return (maybe(hot(keys)), maybe(hot(names)), maybe(float(rng.randint(0, 4))), maybe(rng.choice(phases)),
                rng.choice([28, 28, 28, 7]), maybe(rng.randint(-3, 30)))

    return {
        "entity_base": [
            (hot(ids), rng.choice(titles), rng.choice("AB"), rng.choice(seasons), maybe(rng.choice(["series", "movie"])),
             "x", maybe(rng.choice(days)))
            for _ in range(60)
        ],
        "active_snapshot": [(maybe(hot(keys)), maybe(float(rng.randint(0, 4))), rng.choice([28, 28, 7])) for _ in range(40)],
        "funnel_metrics": [(maybe(hot(keys)), maybe(rng.randint(0, 4) / 4), rng.choice([28, 28, 7])) for _ in range(40)],
        "active_forecast": [forecast() for _ in range(80)],
        "view_forecast": [(*forecast(), maybe(rng.choice(days))) for _ in range(80)],
        "daily_forecast": [
            (maybe(hot(ids)), rng.choice(titles), rng.choice(seasons), maybe(rng.choice([0, 1, 2])),
             maybe(float(rng.randint(0, 3))), maybe(rng.choice(["past", "alpha"])))
            for _ in range(60)
        ],
        "future_forecast": [
            (maybe(hot(titles)), rng.choice(seasons), maybe(rng.choice(days)), rng.choice("AB"), "series", "x",
             maybe(float(rng.randint(0, 3))), rng.choice(["alpha", "alpha", "beta"]))
            for _ in range(60)
        ],
    }


def restated(inputs):
    """The endpoint by nested loops over Python rows."""

    def named(name):
        return [dict(zip(SCHEMAS[name].names, row, strict=True)) for row in inputs[name]]

    def name_of(row):
        season = row["season_number"]
        if season is None or season <= 0 or row["title_name"] is None:
            return row["title_name"]
        return f"{row['title_name']} S{season}"

    def high(value):  # NULL after every value when descending
        return (value is not None, value if value is not None else 0)

    def low_null_first(value):
        return (value is None, value if value is not None else 0)

    def newest(rows, key, extra=()):
        best = {}
        for row in rows:
            rank = (low_null_first(row["pred_day"]), high(row["prediction"]), high(row["phase"] or ""),
                    *[(row[c] is not None, row[c] or date.min if c.endswith("date") else row[c] or "") for c in extra])
            if row[key] not in best or rank > best[row[key]][0]:
                best[row[key]] = (rank, row)
        return [row for _, row in best.values()]

    def sums(rows, keys, measure):
        groups = {}
        for row in rows:
            groups.setdefault(tuple(row[k] for k in keys), []).append(row[measure])
        return [
            (dict(zip(keys, key, strict=True)), sum(v for v in values if v is not None) if any(v is not None for v in values) else None)
            for key, values in groups.items()
        ]

    def matches(rows, **wanted):
        if any(value is None for value in wanted.values()):
            return []
        return [row for row in rows if all(row[k] == v for k, v in wanted.items())]

    active_measured = [r for r in named("active_snapshot") if r["days_on_platform"] == 28]
    view_measured = [r for r in named("funnel_metrics") if r["days_since_first_offered"] == 28]

    def post(r):
        return r["phase"] == "Post-Launch" and r["target_day"] == 28 and r["pred_day"] is not None and r["pred_day"] <= 28

    def pre(r):
        return r["phase"] not in (None, "Post-Launch") and r["target_day"] == 28

    active_forecast = newest(filter(post, named("active_forecast")), "match_id")
    view_forecast = newest(filter(post, named("view_forecast")), "match_id")
    active_early = newest(
        (r for r in named("active_forecast") if pre(r) and r["pred_day"] is not None and r["pred_day"] <= 0), "title_name"
    )
    view_early = newest(filter(pre, named("view_forecast")), "match_id", ["title_name", "effective_start_date"])
    sums_past = sums(
        [r for r in named("daily_forecast") if r["schedule_label"] == "past"],
        ["title_id", "title_name", "season_number", "finished_window_flag"], "predicted_first_views",
    )
    past_rows = [{**key, "views": total} for key, total in sums_past]

    result = set()
    for b in named("entity_base"):
        season, key = b["season_number"], b["title_id"]
        if b["content_category"] == "series":
            key = None if season is None else f"{key}-{season}"
        for am in matches(active_measured, match_id=key) or [None]:
            for vm in matches(view_measured, match_id=key) or [None]:
                for al in matches(active_forecast, match_id=key) or [None]:
                    for vl in matches(view_forecast, match_id=key) or [None]:
                        for sl in matches(past_rows, title_id=b["title_id"], season_number=season) or [None]:
                            active = am["pct_actives"] if am else None
                            active = active if active is not None else (al["prediction"] if al else None)
                            view = vm["retail_viewed_count_percent"] if vm else None
                            view = view * 100 if view is not None else (vl["prediction"] if vl else None)
                            result.add((
                                b["title_id"], key, b["title_name"].title(), name_of(b), b["effective_start_date"], b["tier"],
                                season, b["category"], b["content_category"], active, view, sl["views"] if sl else None,
                                "actual" if vm else ("postlaunch" if vl else None),
                                None if not sl else "actual" if sl["finished_window_flag"] == 1 else "postlaunch",
                            ))
    keys = ["title_name", "season_number", "premiere_date", "tier", "content_category", "category"]
    for f, total in sums([r for r in named("future_forecast") if r["schedule_label"] == "alpha"], keys, "first_views_pred"):
        name = name_of(f)
        for af in matches(active_early, title_name=name) or [None]:
            for vf in matches(view_early, title_name=name) or [None]:
                result.add((
                    None, None, f["title_name"].title() if f["title_name"] else None, name, f["premiere_date"], f["tier"],
                    f["season_number"], f["category"], f["content_category"], af["prediction"] if af else None,
                    vf["prediction"] if vf else None, total,
                    None if not af else "prelaunch" if af["phase"] == "Pre-Launch" else "postgreenlight", "postgreenlight",
                ))
    return result


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("broadcasts", [True, False])
def test_random_inputs(spark, tmp_path, seed, broadcasts):
    inputs = random_inputs(seed)
    golden.write_inputs(spark, str(tmp_path / "inputs"), inputs, files=3)
    tables = from_parquet(spark, str(tmp_path / "inputs"))
    limits = {} if broadcasts else dict.fromkeys(["spark__sql__autoBroadcastJoinThreshold", "spark__sql__adaptive__autoBroadcastJoinThreshold"], "-1")
    with settings(spark, **limits):
        rows = rows_of(build_endpoint(tables))
    expected = restated(inputs)
    assert len(rows) == len(set(rows)), "the endpoint holds a row twice"
    assert set(rows) == expected
    assert future(tables).where("title_id IS NOT NULL OR match_id IS NOT NULL").isEmpty()
    if broadcasts:
        generic = rows_of(union_distinct(launched(tables), future(tables), RESULT_SCHEMA.names))
        assert len(generic) == len(rows) and set(generic) == expected
