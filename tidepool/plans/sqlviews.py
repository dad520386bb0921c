"""SQL text of the fixture views, for the independent DuckDB oracle.

These mirror ``tidepool.sources.fixtures`` definition by definition; an
oracle query is ``with_views(body)``, which prepends only the views the
body mentions (plus their dependencies) as CTEs.
"""

from __future__ import annotations

import re

from tidepool import schema as S


def clip(e: str, lo: float = 0.0, hi: float = 1.0) -> str:
    return f"(CASE WHEN ({e}) IS NULL OR isnan({e}) THEN NULL ELSE greatest({lo}, least({hi}, {e})) END)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def health_score(p: str = "") -> str:
    return clip(
        f"0.20 * {clip(f'({p}water_temperature_c - 28.5) / 4.5')}"
        f" + 0.12 * {clip(f'(8.10 - {p}ph) / 0.55')}"
        f" + 0.08 * {clip(f'(6.00 - {p}dissolved_oxygen_mg_l) / 3.50')}"
        f" + 0.10 * {clip(f'{p}turbidity_ntu / 20.0')}"
        f" + 0.25 * ({p}bleaching_percentage / 100.0)"
        f" + 0.12 * {clip(f'{p}disease_percentage / 45.0')}"
        f" + 0.13 * {clip(f'1.0 - {p}coral_cover_percentage / 72.0')}"
    )


def restoration_score(p: str = "") -> str:
    return clip(
        f"0.15 * {clip(f'1.0 - abs({p}water_temperature_c - 28.0) / 6.5')}"
        f" + 0.12 * {clip(f'({p}ph - 7.75) / 0.55')}"
        f" + 0.10 * {clip(f'{p}light_intensity / 500.0')}"
        f" + 0.22 * {clip(f'{p}hard_substrate_percentage / 100.0')}"
        f" + 0.10 * {clip(f'1.0 - abs({p}current_speed_m_s - 0.18) / 0.45')}"
        f" + 0.12 * {clip(f'1.0 - {p}turbidity_ntu / 18.0')}"
        f" + 0.09 * {clip(f'1.0 - greatest(0.0, {p}depth_m - 15.0) / 25.0')}"
        f" + 0.10 * {clip(f'{p}coral_cover_percentage / 65.0')}"
    )


def health_class(s: str) -> str:
    t1, t2, t3 = S.HEALTH_THRESHOLDS
    return (
        f"(CASE WHEN {s} < {t1} THEN 'healthy' WHEN {s} < {t2} THEN 'stressed' "
        f"WHEN {s} < {t3} THEN 'bleached' WHEN {s} >= {t3} THEN 'severely_degraded' END)"
    )


def restoration_class(s: str) -> str:
    t1, t2 = S.RESTORATION_THRESHOLDS
    return (
        f"(CASE WHEN {s} < {t1} THEN 'unsuitable' WHEN {s} < {t2} THEN 'moderately_suitable' "
        f"WHEN {s} >= {t2} THEN 'suitable' END)"
    )


def derived_features(ph_norm: float = 0.55, turb_norm: float = 20.0, p: str = "") -> dict[str, str]:
    tsi = clip(f"({p}water_temperature_c - 28.5) / 4.5")
    osi = clip(f"(6.0 - {p}dissolved_oxygen_mg_l) / 3.5")
    dev = f"abs({p}ph - 8.1)"
    rug = f"(({p}rugosity_index - 1.0) / 9.0)"
    wqi = clip(
        f"1.0 - (0.40 * {tsi} + 0.30 * {osi} + 0.20 * {clip(f'{dev} / {ph_norm}')}"
        f" + 0.10 * {clip(f'{p}turbidity_ntu / {turb_norm}')})"
    )
    return {
        "thermal_stress_index": tsi,
        "oxygen_stress_index": osi,
        "acidity_deviation": dev,
        "water_quality_index": wqi,
        "substrate_stability_score": clip(f"0.60 * ({p}hard_substrate_percentage / 100.0) + 0.40 * {rug}"),
        "structural_complexity_score": clip(f"0.5 * {p}acoustic_complexity_index + 0.5 * {rug}"),
    }


def derived_select(ph_norm: float = 0.55, turb_norm: float = 20.0, p: str = "") -> str:
    return ", ".join(f"{e} AS {n}" for n, e in derived_features(ph_norm, turb_norm, p).items())


_OBS_BASE = """
obs_b AS (
  SELECT l.l_orderkey AS ok, l.l_linenumber AS ln, l.l_partkey AS pk, l.l_suppkey AS sk, l.l_shipdate AS ts,
         CAST(l.l_quantity AS BIGINT) AS q, CAST(floor(l.l_extendedprice*100) AS BIGINT) AS ep,
         CAST(floor(l.l_discount*100+0.5) AS BIGINT) AS disc, CAST(floor(l.l_tax*100+0.5) AS BIGINT) AS tax,
         CAST(floor(o.o_totalprice*100) AS BIGINT) AS tp, n.n_regionkey AS rk
  FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey
       JOIN customer c ON o.o_custkey=c.c_custkey JOIN nation n ON c.c_nationkey=n.n_nationkey),
obs_base AS (
SELECT concat_ws('-', CAST(ok AS VARCHAR), CAST(ln AS VARCHAR), CAST(pk AS VARCHAR), CAST(sk AS VARCHAR), CAST(ep AS VARCHAR)) AS obs_id,
  ts AS timestamp,
  CASE rk WHEN 0 THEN 'Lakshadweep' WHEN 1 THEN 'Gulf of Mannar' WHEN 2 THEN 'Gulf of Kutch'
          ELSE 'Andaman and Nicobar Islands' END AS region,
  CASE rk WHEN 0 THEN 10.0e0 WHEN 1 THEN 8.5e0 WHEN 2 THEN 22.0e0 ELSE 6.5e0 END + CAST(pk%200 AS DOUBLE)/100 AS latitude,
  CASE rk WHEN 0 THEN 72.0e0 WHEN 1 THEN 78.0e0 WHEN 2 THEN 68.0e0 ELSE 92.0e0 END + CAST(ok%200 AS DOUBLE)/100 AS longitude,
  CAST(q*75 AS DOUBLE)/100 AS depth_m,
  CAST(2400+ep%1200 AS DOUBLE)/100 AS water_temperature_c,
  CAST(7600+tp%800 AS DOUBLE)/1000 AS ph,
  CAST(3100+ep%1300 AS DOUBLE)/100 AS salinity_ppt,
  CAST(200+tp%900 AS DOUBLE)/100 AS dissolved_oxygen_mg_l,
  CAST((ep%57)*(ep%57) AS DOUBLE)/100 AS turbidity_ntu,
  CAST(50+tp%20000 AS DOUBLE)/10 AS light_intensity,
  CAST(5+ep%900 AS DOUBLE)/1000 AS current_speed_m_s,
  CAST(-3600+pk%3400 AS DOUBLE)/100 AS sonar_backscatter,
  CAST(1000+(pk*7)%3800 AS DOUBLE)/1000 AS rugosity_index,
  CAST((pk*13+q)%1001 AS DOUBLE)/10 AS hard_substrate_percentage,
  CAST(500+(ok*3+q)%9500 AS DOUBLE)/10000 AS acoustic_complexity_index,
  CAST((ok*17+ln)%901 AS DOUBLE)/10 AS coral_cover_percentage,
  CAST((tp%701)*(disc+1)%1001 AS DOUBLE)/10 AS bleaching_percentage,
  CAST((ep%401)+tax*20 AS DOUBLE)/10 AS disease_percentage,
  ok AS _ok, ep AS _ep
FROM obs_b)"""

_OBS_COLS = ", ".join(S.OBSERVATION_COLUMNS[:-2])

VIEWS: dict[str, str] = {
    "obs_base": _OBS_BASE,
    "obs_labelled": f"""
obs_labelled AS (
  SELECT *, {health_class(f"round({health_score()}, 9)")} AS reef_health,
         {restoration_class(f"round({restoration_score()}, 9)")} AS restoration_suitability
  FROM obs_base)""",
    "observations": f"""
observations AS (SELECT {_OBS_COLS}, reef_health, restoration_suitability FROM obs_labelled)""",
    "scored_health": f"""
scored_health AS (
  SELECT obs_id, region,
    {health_class(f"round({health_score()} + CAST((_ep*31+_ok) % 151 - 75 AS DOUBLE)/1000, 9)")} AS y_true,
    {health_class(f"round({health_score()}, 9)")} AS y_pred
  FROM obs_base)""",
    "scored_restoration": f"""
scored_restoration AS (
  SELECT obs_id, region,
    {restoration_class(f"round({restoration_score()} + CAST((_ep*31+_ok) % 151 - 75 AS DOUBLE)/1000, 9)")} AS y_true,
    {restoration_class(f"round({restoration_score()}, 9)")} AS y_pred
  FROM obs_base)""",
    "obs_dmg": f"""
obs_dmg AS (
  SELECT obs_id, timestamp,
    CASE WHEN _ep % 97 = 2 THEN 'Unknown Reef' ELSE region END AS region,
    CASE WHEN _ep % 97 = 3 THEN latitude + 30 ELSE latitude END AS latitude,
    longitude, depth_m,
    CASE WHEN _ep % 97 = 1 THEN CAST(NULL AS DOUBLE) ELSE water_temperature_c END AS water_temperature_c,
    CASE WHEN _ep % 97 = 0 THEN 6.5 ELSE ph END AS ph,
    salinity_ppt, dissolved_oxygen_mg_l, turbidity_ntu, light_intensity, current_speed_m_s,
    sonar_backscatter, rugosity_index, hard_substrate_percentage, acoustic_complexity_index,
    coral_cover_percentage,
    CASE WHEN _ep % 97 = 4 THEN 120.0 ELSE bleaching_percentage END AS bleaching_percentage,
    disease_percentage, reef_health, restoration_suitability,
    CASE WHEN _ep % 97 = 5 THEN 'abc' ELSE CAST(depth_m AS VARCHAR) END AS depth_text,
    _ep
  FROM obs_labelled)""",
    "observations_dirty": """
observations_dirty AS (SELECT * FROM obs_dmg UNION ALL SELECT * FROM obs_dmg WHERE _ep % 97 = 6)""",
    "region_bounds": "\nregion_bounds AS (SELECT * FROM (VALUES "
    + ", ".join(f"({q(k)}, {a}, {b}, {c}, {d})" for k, (a, b, c, d) in S.REGION_BOUNDS.items())
    + ") t(region, lat_min, lat_max, lon_min, lon_max))",
    "grid_cells": """
grid_cells AS (
  SELECT event_type AS product, CAST(ts AS DATE) AS time, CAST(user_id % 20 AS INTEGER) AS lat_idx,
         CAST(floor(user_id / 20) AS INTEGER) AS lon_idx,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(value) / 100 AS value,
         max(CAST(event_id % 53 = 0 AS INTEGER)) AS _hole
  FROM events GROUP BY 1, 2, 3, 4)""",
    "grid_daily": f"""
grid_daily AS (
  SELECT product,
    CASE lat_idx % 4 WHEN 0 THEN {q(S.REGIONS[0])} WHEN 1 THEN {q(S.REGIONS[1])} WHEN 2 THEN {q(S.REGIONS[2])}
         ELSE {q(S.REGIONS[3])} END AS region,
    time, lat_idx, lon_idx, 8.0 + lat_idx * 0.05 AS lat, 72.0 + lon_idx * 0.05 AS lon, value
  FROM grid_cells)""",
    "grid_daily_b": f"""
grid_daily_b AS (
  SELECT product,
    CASE lat_idx % 4 WHEN 0 THEN {q(S.REGIONS[0])} WHEN 1 THEN {q(S.REGIONS[1])} WHEN 2 THEN {q(S.REGIONS[2])}
         ELSE {q(S.REGIONS[3])} END AS region,
    time, lat_idx, lon_idx, 8.0 + lat_idx * 0.05 AS lat, 72.0 + lon_idx * 0.05 AS lon,
    CASE WHEN _hole = 1 THEN CAST(NULL AS DOUBLE) ELSE value END AS value
  FROM grid_cells)""",
    "grid_history": f"""
grid_history AS (
  SELECT CASE o_custkey % 4 WHEN 0 THEN {q(S.REGIONS[0])} WHEN 1 THEN {q(S.REGIONS[1])}
              WHEN 2 THEN {q(S.REGIONS[2])} ELSE {q(S.REGIONS[3])} END AS region,
         CAST(o_orderdate AS DATE) AS time, CAST(o_custkey % 7 AS INTEGER) AS lat_idx,
         CAST(o_orderkey % 5 AS INTEGER) AS lon_idx,
         CAST(CAST(floor(o_totalprice) AS BIGINT) % 1600 / 100 AS DOUBLE) AS dhw,
         (2400.0 + CAST(floor(o_totalprice) AS BIGINT) % 900) / 100 AS sst
  FROM orders)""",
    "grid_history_cells": """
grid_history_cells AS (SELECT time, lat_idx, lon_idx, max(dhw) AS value FROM grid_history GROUP BY 1, 2, 3)""",
    "grid_elevation": f"""
grid_elevation AS (
  SELECT CASE p_partkey % 4 WHEN 0 THEN {q(S.REGIONS[0])} WHEN 1 THEN {q(S.REGIONS[1])}
              WHEN 2 THEN {q(S.REGIONS[2])} ELSE {q(S.REGIONS[3])} END AS region,
         CAST(p_partkey % 50 AS INTEGER) AS lat_idx, CAST(floor(p_partkey / 50) AS INTEGER) AS lon_idx,
         8.0 + CAST(p_partkey % 50 AS DOUBLE) / 240 AS lat,
         72.0 + CAST(floor(p_partkey / 50) AS DOUBLE) / 240 AS lon,
         CAST((p_partkey * 37) % 400 - 250 AS INTEGER) AS elevation
  FROM part)""",
    "survey_grid": """
survey_grid AS (
  SELECT CAST(o_orderdate AS DATE) AS time,
         CAST(CASE o_custkey % 4 WHEN 0 THEN 40 WHEN 1 THEN 34 WHEN 2 THEN 88 ELSE 26 END + (o_custkey // 4) % 9 AS INTEGER) AS lat_idx,
         CAST(CASE o_custkey % 4 WHEN 0 THEN 288 WHEN 1 THEN 312 WHEN 2 THEN 272 ELSE 368 END + o_orderkey % 9 AS INTEGER) AS lon_idx,
         max(CAST(floor(o_totalprice) AS BIGINT) % 1600 / 100) AS value
  FROM orders GROUP BY 1, 2, 3)""",
    "survey_raster": """
survey_raster AS (
  SELECT CAST(CASE p_partkey % 4 WHEN 0 THEN 200 WHEN 1 THEN 170 WHEN 2 THEN 440 ELSE 130 END + (p_partkey // 4) % 41 AS INTEGER) AS lat_idx,
         CAST(CASE p_partkey % 4 WHEN 0 THEN 1440 WHEN 1 THEN 1560 WHEN 2 THEN 1360 ELSE 1840 END + (p_partkey // 164) % 41 AS INTEGER) AS lon_idx,
         CAST(min((p_partkey * 37) % 400 - 250) AS INTEGER) AS elevation
  FROM part GROUP BY 1, 2)""",
    "alias_events": """
alias_events AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'reef_health_model' ELSE 'restoration_model' END AS model_name,
         event_id AS version, 'run-' || CAST(event_id AS VARCHAR) AS run_id, ts
  FROM events)""",
}

DEPENDS = {
    "obs_base": ["obs_b"],
    "obs_labelled": ["obs_base"],
    "observations": ["obs_labelled"],
    "scored_health": ["obs_base"],
    "scored_restoration": ["obs_base"],
    "obs_dmg": ["obs_labelled"],
    "observations_dirty": ["obs_dmg"],
    "grid_daily": ["grid_cells"],
    "grid_daily_b": ["grid_cells"],
    "grid_history_cells": ["grid_history"],
}


def _run_metrics_view() -> str:
    from tidepool.sources.fixtures import RUN_METRICS

    def lit(v):
        return "CAST(NULL AS DOUBLE)" if v is None else (q(v) if isinstance(v, str) else f"CAST({v} AS DOUBLE)")

    rows = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in RUN_METRICS)
    return (
        f"\nrun_metrics AS (SELECT * FROM (VALUES {rows}) t(run_id, task, algorithm, cv_macro_f1, "
        "cv_balanced_accuracy, test_macro_f1, test_balanced_accuracy, test_accuracy))"
    )


VIEWS["run_metrics"] = _run_metrics_view()

_ORDER = list(VIEWS)


def with_views(body: str, *extra: CTE) -> str:
    """Prepend the CTEs (in dependency order) for every view name the body uses."""
    extras = list(extra)
    text = body + " ".join(e[1] for e in extras)
    needed: set[str] = set()

    def need(name: str) -> None:
        if name in needed or name == "obs_b":
            return
        needed.add(name)
        for d in DEPENDS.get(name, []):
            need(d)

    for name in _ORDER:
        if re.search(rf"\b{name}\b", text):
            need(name)
    parts = [VIEWS[n].strip() for n in _ORDER if n in needed]
    parts += [f"{n} AS ({s})" for n, s in extras]
    if not parts:
        return body
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + stripped[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


CTE = tuple  # (name, sql)


def _scorer_sql(task: str, name: str | None = None, src: str = "obs_base") -> str:
    from tidepool.sources.fixtures import SCORER_CENTRES

    s = f"round({health_score() if task == 'health' else restoration_score()}, 9)"
    cs = SCORER_CENTRES[task]
    names, cv = list(cs), list(cs.values())
    order = sorted(range(len(cv)), key=lambda i: cv[i])
    whens = []
    for a, b in zip(order, order[1:]):
        mid = (cv[a] + cv[b]) / 2
        op = "<=" if a < b else "<"
        whens.append(f"WHEN s {op} {mid!r} THEN {q(names[a])}")
    pred = "CASE " + " ".join(whens) + f" ELSE {q(names[order[-1]])} END"
    ws = [f"(1.0 / (1.0 + 100.0 * (s - {c}) * (s - {c})))" for c in cv]
    total = "(" + " + ".join(ws) + ")"
    dmin = "least(" + ", ".join(f"abs(s - {c})" for c in cv) + ")"
    keys = ", ".join(q(c) for c in names)
    vals = ", ".join(f"round({w} / {total}, 6)" for w in ws)
    conf = f"round((1.0 / (1.0 + 100.0 * {dmin} * {dmin})) / {total}, 6)"
    name = name or f"predictions_{task}"
    return (
        f"\n{name} AS (SELECT obs_id, region, {q(task)} AS task, {pred} AS predicted_class, "
        f"map([{keys}], [{vals}]) AS probabilities, {conf} AS confidence FROM (SELECT *, {s} AS s FROM {src}))"
    )


def shift_select(scale: float = 1.0) -> str:
    from tidepool import schema as S

    parts = []
    for c, mag in S.SHIFTS.items():
        lo, hi = S.SHIFT_CLIP[c]
        parts.append(f"{clip(f'{c} + {scale} * {mag}', lo, hi)} AS {c}")
    return ", ".join(parts)


_UNLABELLED = "* EXCLUDE (reef_health, restoration_suitability)"


def _sample(seed: int) -> str:
    return f"(SELECT * FROM observations ORDER BY md5('{seed}|' || obs_id), obs_id LIMIT {S.SAMPLE_WINDOW_ROWS})"


VIEWS["ref_sample"] = f"\nref_sample AS (SELECT {_UNLABELLED} FROM {_sample(42)})"
VIEWS["prod_sample"] = f"\nprod_sample AS (SELECT {_UNLABELLED} REPLACE ({shift_select(1.0)}) FROM {_sample(43)})"
VIEWS["ref_window"] = f"\nref_window AS (SELECT {_UNLABELLED} FROM observations WHERE timestamp < TIMESTAMP '{S.WINDOW_CUT}')"
VIEWS["prod_window"] = f"\nprod_window AS (SELECT {_UNLABELLED} REPLACE ({shift_select(1.0)}) FROM observations WHERE timestamp >= TIMESTAMP '{S.WINDOW_CUT}')"
for _w in ("ref_sample", "prod_sample", "ref_window", "prod_window"):
    DEPENDS[_w] = ["observations"]
for _t in ("health", "restoration"):
    VIEWS[f"predictions_{_t}"] = _scorer_sql(_t)
    DEPENDS[f"predictions_{_t}"] = ["obs_base"]
    VIEWS[f"ref_pred_{_t}"] = _scorer_sql(_t, f"ref_pred_{_t}", "ref_window")
    DEPENDS[f"ref_pred_{_t}"] = ["ref_window"]
    VIEWS[f"prod_pred_{_t}"] = _scorer_sql(_t, f"prod_pred_{_t}", "prod_window")
    DEPENDS[f"prod_pred_{_t}"] = ["prod_window"]
_ORDER[:] = list(VIEWS)
