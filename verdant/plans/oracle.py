"""DuckDB SQL oracles for the registered queries.

Each oracle restates the operator's semantics in plain SQL over the driver's
tables (window functions over whole keys, exact ``quantile_cont``, explicit
iteration for the weight clipping).  Output columns and rounding match
``registry.finish``: doubles rounded to 6 decimals, integral columns BIGINT.
"""

from __future__ import annotations

from ..config import (BLEND_MODEL, BLEND_UNIFORM, MAX_WEIGHT_BONUS, MAX_WEIGHT_CAP, MAX_WEIGHT_FLOOR,
                      MIN_WEIGHT_FEW, MIN_WEIGHT_MANY, PREFERRED_BOOST, RMSE_FLOOR, SEQUENCE_LENGTH,
                      TEST_RATIO, VALIDATION_RATIO, WEIGHT_ITERATIONS, WEIGHT_TOLERANCE)
from ..sources.tables import EVENT_INVALID_CODE, SECOND_COPY_ORDER
from .forecast import EVENT_THRESHOLDS

L = SEQUENCE_LENGTH
FEATS = ["indoor_temperature_c", "humidity_pct"]
PREFERRED = "linear_baseline"


def r(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


def b(expr: str, alias: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {alias}"


def fz(e: str) -> str:
    return f"(CASE WHEN {e} IS NULL OR isnan({e}) OR isinf({e}) THEN 0.0 ELSE {e} END)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- shared CTEs

def _obs(value: str) -> str:
    return f"""obs AS (
  SELECT CASE WHEN event_type IS NULL THEN 'nan' WHEN trim(event_type) = '' THEN 'mixed_crop'
              ELSE lower(trim(event_type)) END AS crop_type, CAST(ts AS TIMESTAMP) AS "timestamp",
         {value} AS indoor_temperature_c,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity_pct,
         event_id AS _order
  FROM events)"""


OBS = _obs("value")
OBS_BLANK = _obs(f"""CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) >= {EVENT_INVALID_CODE}
              THEN NULL ELSE value END""")
# Every observation and an altered copy of it, later in input order.
OBS_TWICE = OBS.replace("obs AS", "once AS", 1) + f""",
obs AS (SELECT * FROM once UNION ALL
  SELECT crop_type, "timestamp", indoor_temperature_c + 1000, NULL, _order + {SECOND_COPY_ORDER} FROM once)"""

DEDUP = """dedup AS (
  SELECT crop_type, "timestamp", indoor_temperature_c, humidity_pct FROM obs
  WHERE "timestamp" IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY crop_type, "timestamp" ORDER BY _order) = 1)"""

RANKED = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY crop_type ORDER BY "timestamp") AS _pos,
         count(*) OVER (PARTITION BY crop_type) AS _n
  FROM dedup)"""


def interp_ctes(src: str, out: str, cols: list[str], key: str = "crop_type") -> list[str]:
    nb = []
    for c in cols:
        vp = f"CASE WHEN {c} IS NOT NULL THEN _pos END"
        nb += [f"last_value({c} IGNORE NULLS) OVER wp AS pv_{c}",
               f"last_value({vp} IGNORE NULLS) OVER wp AS pp_{c}",
               f"first_value({c} IGNORE NULLS) OVER wn AS nv_{c}",
               f"first_value({vp} IGNORE NULLS) OVER wn AS np_{c}"]
    fills = []
    for c in cols:
        fills.append(
            f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN pv_{c} IS NULL THEN nv_{c} "
            f"WHEN nv_{c} IS NULL OR np_{c} = pp_{c} THEN pv_{c} "
            f"ELSE pv_{c} + (nv_{c} - pv_{c}) * (_pos - pp_{c}) / (np_{c} - pp_{c}) END AS {c}")
    return [
        f"""{out}_nb AS (SELECT *, {', '.join(nb)} FROM {src}
  WINDOW wp AS (PARTITION BY {key} ORDER BY _pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wn AS (PARTITION BY {key} ORDER BY _pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
        f"""{out} AS (SELECT {key}, "timestamp", _pos, _n, {', '.join(fills)} FROM {out}_nb)""",
    ]


def clean_ctes(src: str, cols: list[str], key: str = "crop_type") -> list[str]:
    """interp -> global median fill -> global 1%/99% clip, producing ``cleaned``."""
    med = ", ".join(f"median({c}) AS m_{c}" for c in cols)
    fill = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in cols)
    qs = ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in cols)
    clip = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, lo_{c}), hi_{c}) END AS {c}"
                     for c in cols)
    return interp_ctes(src, "interp", cols, key) + [
        f"gmed AS (SELECT {med} FROM interp)",
        f'filled AS (SELECT {key}, "timestamp", _pos, _n, {fill} FROM interp, gmed)',
        f"clipq AS (SELECT {qs} FROM filled)",
        f'cleaned AS (SELECT {key}, "timestamp", _pos, _n, {clip} FROM filled, clipq)',
    ]


CLEAN = [OBS, DEDUP, RANKED, *clean_ctes("ranked", FEATS)]

SCALE = [
    "grp AS (SELECT * FROM cleaned WHERE _n >= 12)",
    "params AS (SELECT crop_type, " + ", ".join(
        f"min({c}) AS {c}__min, max({c}) AS {c}__max" for c in FEATS) + " FROM grp GROUP BY crop_type)",
    'scaled AS (SELECT g.crop_type, g."timestamp", g._pos, g._n, ' + ", ".join(
        f"CASE WHEN p.{c}__max = p.{c}__min THEN 0.0 ELSE (g.{c} - p.{c}__min) / (p.{c}__max - p.{c}__min) END AS {c}"
        for c in FEATS) + " FROM grp g JOIN params p USING (crop_type))",
]


def _window_ctes() -> list[str]:
    lags = ", ".join(f"lag({c}, {k}) OVER w AS {c}__lag{k}" for k in range(1, L + 1) for c in FEATS)
    xs = [f"CAST(CAST({fz(f'{c}__lag{k}')} AS FLOAT) AS DOUBLE)" for k in range(L, 0, -1) for c in FEATS]
    xcols = ", ".join(f"{x} AS x{i + 1:02d}" for i, x in enumerate(xs))
    k_expr = f"greatest(1, least(CAST(floor(_n * {1.0 - TEST_RATIO!r}::DOUBLE) AS BIGINT), _n - 1))"
    return [
        f"splitted AS (SELECT *, {k_expr} AS _k FROM scaled)",
        f"lagged AS (SELECT *, {lags} FROM splitted WINDOW w AS (PARTITION BY crop_type ORDER BY _pos))",
        f"""win0 AS (SELECT crop_type, "timestamp", _pos,
            CASE WHEN _pos <= _k THEN 'train' ELSE 'test' END AS split,
            CASE WHEN _pos <= _k THEN _pos - {L} ELSE _pos - _k - {L} END AS win,
            {xcols}, CAST(CAST({fz('indoor_temperature_c')} AS FLOAT) AS DOUBLE) AS y,
            greatest(_k - {L}, 0) AS n_tr, greatest(_n - _k - {L}, 0) AS n_te, _pos <= _k AS in_train
          FROM lagged)""",
        f"""allwin AS (SELECT *,
            in_train AND (n_tr < 5 OR win > n_tr - greatest(1, CAST(floor(n_tr * {VALIDATION_RATIO!r}::DOUBLE) AS BIGINT))) AS is_val,
            in_train AND (n_tr < 5 OR win <= n_tr - greatest(1, CAST(floor(n_tr * {VALIDATION_RATIO!r}::DOUBLE) AS BIGINT))) AS is_fit
          FROM win0 WHERE win >= 1)""",
        "wins AS (SELECT * FROM allwin WHERE n_tr >= 3 AND n_te > 0)",
    ]


WINDOWS = _window_ctes()
LAST_T = f"x{(L - 1) * len(FEATS) + 1:02d}"

PREDS = [
    f"""scored AS (
      SELECT crop_type, "timestamp", 'val' AS split, y, {LAST_T} AS lag1, is_fit FROM wins WHERE is_val
      UNION ALL
      SELECT crop_type, "timestamp", 'test' AS split, y, {LAST_T} AS lag1, is_fit FROM wins WHERE split = 'test')""",
    f"""ar AS (SELECT crop_type, regr_slope(y, {LAST_T}) AS slope, regr_intercept(y, {LAST_T}) AS intercept
          FROM wins WHERE is_fit GROUP BY crop_type)""",
    """preds AS (
      SELECT crop_type, "timestamp", split, 'naive_persistence' AS model, y, lag1 AS yhat FROM scored
      UNION ALL
      SELECT s.crop_type, s."timestamp", s.split, 'linear_baseline' AS model, s.y, a.intercept + a.slope * s.lag1
      FROM scored s LEFT JOIN ar a USING (crop_type))""",
]


def _weight_ctes() -> list[str]:
    ctes = [
        """per AS (SELECT crop_type, model, count(*) FILTER (WHERE split = 'val') AS n_val,
                 count(*) FILTER (WHERE split = 'test') AS n_test,
                 count(*) FILTER (WHERE yhat IS NULL OR isnan(yhat)) AS n_bad
               FROM preds GROUP BY crop_type, model)""",
        "expct AS (SELECT crop_type, max(n_val) AS n_expected FROM per WHERE n_val > 0 GROUP BY crop_type)",
        """okm AS (SELECT p.crop_type, p.model FROM per p LEFT JOIN expct e USING (crop_type)
               WHERE n_bad = 0 AND n_test > 0 AND n_val = n_expected)""",
        "kept AS (SELECT * FROM preds WHERE (crop_type, model) IN (SELECT (crop_type, model) FROM okm))",
        """vrmse AS (SELECT crop_type, model, sqrt(avg(power(y - yhat, 2))) AS validation_rmse
               FROM kept WHERE split = 'val' GROUP BY crop_type, model)""",
        f"""sc AS (SELECT *, (1.0::DOUBLE / greatest(validation_rmse, {RMSE_FLOOR!r}::DOUBLE))
                 * CASE WHEN model = '{PREFERRED}' THEN {PREFERRED_BOOST!r}::DOUBLE ELSE 1.0::DOUBLE END AS score
               FROM vrmse)""",
        f"""ws0 AS (SELECT *, {fz('score')} AS s FROM sc)""",
        f"""ws1 AS (SELECT *, CAST(count(*) OVER (PARTITION BY crop_type) AS DOUBLE) AS n,
                 bool_and(s <= 0) OVER (PARTITION BY crop_type) AS allnonpos,
                 ln(1 + greatest(s, 0.0)) AS d FROM ws0)""",
        f"""ws2 AS (SELECT *, {BLEND_MODEL!r}::DOUBLE * (d / greatest(sum(d) OVER (PARTITION BY crop_type), 1e-12))
                 + {BLEND_UNIFORM!r}::DOUBLE * (1.0::DOUBLE / n) AS bl,
                 least(greatest({MAX_WEIGHT_FLOOR!r}::DOUBLE, 1.0::DOUBLE / n + {MAX_WEIGHT_BONUS!r}::DOUBLE),
                       {MAX_WEIGHT_CAP!r}::DOUBLE) AS maxw,
                 CASE WHEN n >= 5 THEN {MIN_WEIGHT_MANY!r}::DOUBLE ELSE {MIN_WEIGHT_FEW!r}::DOUBLE END AS minw
               FROM ws1)""",
        "it0 AS (SELECT crop_type, model, validation_rmse, score, n, allnonpos, maxw, minw, bl AS w, false AS done FROM ws2)",
    ]
    base = "crop_type, model, validation_rmse, score, n, allnonpos, maxw, minw"
    for i in range(1, WEIGHT_ITERATIONS + 1):
        ctes += [
            f"c{i} AS (SELECT *, least(greatest(w, minw), maxw) AS cw FROM it{i - 1})",
            f"t{i} AS (SELECT *, sum(cw) OVER (PARTITION BY crop_type) AS tot FROM c{i})",
            f"u{i} AS (SELECT *, CASE WHEN tot <= 0 THEN 1.0::DOUBLE / n ELSE cw / tot END AS nw FROM t{i})",
            f"""o{i} AS (SELECT *, sum(greatest(nw - maxw, 0.0)) OVER (PARTITION BY crop_type) AS ov,
                     sum(greatest(minw - nw, 0.0)) OVER (PARTITION BY crop_type) AS un FROM u{i})""",
            f"""it{i} AS (SELECT {base}, CASE WHEN done THEN w ELSE nw END AS w,
                     CASE WHEN done THEN true ELSE (tot <= 0 OR (ov < {WEIGHT_TOLERANCE!r} AND un < {WEIGHT_TOLERANCE!r})) END AS done
                   FROM o{i})""",
        ]
    ctes.append(f"""weights AS (SELECT crop_type, model, validation_rmse, score,
          CASE WHEN allnonpos THEN 1.0::DOUBLE / n
               ELSE w / greatest(sum(w) OVER (PARTITION BY crop_type), 1e-12) END AS weight
        FROM it{WEIGHT_ITERATIONS})""")
    return ctes


WEIGHTS = _weight_ctes()

HYBRID = [
    """hyb AS (SELECT p.crop_type, p."timestamp", 'test' AS split, 'hybrid_coordinated' AS model,
              first(p.y) AS y, sum(w.weight * p.yhat) AS yhat
            FROM preds p JOIN weights w USING (crop_type, model) WHERE p.split = 'test'
            GROUP BY p.crop_type, p."timestamp")""",
    """testall AS (SELECT crop_type, "timestamp", split, model, y, yhat FROM preds WHERE split = 'test'
                 UNION ALL SELECT * FROM hyb)""",
    """orig AS (SELECT t.crop_type, t."timestamp", t.split, t.model,
              t.y * (p.indoor_temperature_c__max - p.indoor_temperature_c__min) + p.indoor_temperature_c__min AS y,
              t.yhat * (p.indoor_temperature_c__max - p.indoor_temperature_c__min) + p.indoor_temperature_c__min AS yhat
            FROM testall t LEFT JOIN params p USING (crop_type))""",
    """fc AS (SELECT crop_type, "timestamp", y AS actual_temperature_c, yhat AS predicted_temperature_c,
              abs(y - yhat) AS absolute_error_c FROM orig WHERE model = 'hybrid_coordinated')""",
]


def metric_sql(y: str, yhat: str) -> str:
    e = f"({y} - {yhat})"
    sst = f"(count(*) * var_pop({y}))"
    return ", ".join([
        r(f"avg(abs({e}))", "mae"),
        r(f"sqrt(avg({e} * {e}))", "rmse"),
        r(f"coalesce(avg(CASE WHEN abs({y}) > 1e-8 THEN abs({e} / {y}) END) * 100.0, 0.0)", "mape_pct"),
        r(f"CASE WHEN {sst} = 0 THEN 0.0 ELSE 1.0 - sum({e} * {e}) / {sst} END", "r2"),
        b("count(*)", "sample_count"),
    ])


CMP = [
    """cmpm AS (SELECT crop_type, model, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
              CASE WHEN count(*) * var_pop(y) = 0 THEN 0.0
                   ELSE 1.0 - sum((y - yhat) * (y - yhat)) / (count(*) * var_pop(y)) END AS r2
            FROM orig GROUP BY crop_type, model)""",
    """cmp AS (SELECT crop_type, row_number() OVER (PARTITION BY crop_type ORDER BY rmse ASC NULLS LAST, model) AS "rank",
              model, mae, rmse, r2 FROM cmpm)""",
]

LOW, HIGH, SPRAY = EVENT_THRESHOLDS["low"], EVENT_THRESHOLDS["high"], EVENT_THRESHOLDS["spray"]


def _act(field: int) -> str:
    vals = [("'fan_and_spray_on'", 1, 1, "'critical_high_temperature'"), ("'fan_on'", 1, 0, "'high_temperature'"),
            ("'cooling_off'", 0, 0, "'below_cooling_range'"), ("'idle'", 0, 0, "'optimal_range'")]
    t = "predicted_temperature_c"
    return (f"CASE WHEN {t} IS NULL OR isnan({t}) THEN {vals[3][field]} "
            f"WHEN {t} >= {SPRAY} THEN {vals[0][field]} WHEN {t} >= {HIGH} THEN {vals[1][field]} "
            f"WHEN {t} <= {LOW} THEN {vals[2][field]} ELSE {vals[3][field]} END")


ACTIONS = [f"""acts AS (SELECT "timestamp", crop_type, predicted_temperature_c, {_act(0)} AS action,
             {_act(1)} AS fan_on, {_act(2)} AS spray_on, {_act(3)} AS status_note FROM fc)"""]

LABEL = ["""lbl AS (SELECT crop_type, 'balanced_inverse_rmse_weighted_ensemble[' ||
            string_agg(printf('%s:%.2f', model, weight), ', ' ORDER BY weight DESC, model) || ']' AS model_coordination
          FROM weights GROUP BY crop_type)"""]

FULL = CLEAN + SCALE + WINDOWS + PREDS + WEIGHTS + HYBRID


def _event_sql(ctes: list[str], body: str) -> str:
    return with_(*ctes) + body


# ------------------------------------------------------------------ queries

RANK_SQL = """ovr AS (SELECT row_number() OVER (ORDER BY rmse ASC NULLS LAST, model) AS "rank", model, mae, rmse, r2
        FROM (SELECT model, avg(mae) AS mae, avg(rmse) AS rmse, avg(r2) AS r2 FROM cmp GROUP BY model))"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    rank_sql = RANK_SQL
    miss = " UNION ALL ".join(
        [f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE \"{c}\" IS NULL) AS BIGINT) AS missing FROM obs"
         for c in ("crop_type", "timestamp")]
        + [f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS BIGINT) AS missing FROM obs"
           for c in FEATS])
    q["missing_report"] = with_(OBS_BLANK) + miss

    def slug(e):
        return f"trim(regexp_replace(lower(trim({e})), '[^a-z0-9]+', '_', 'g'), '_')"
    q["slugify"] = f"""SELECT p_partkey, coalesce(nullif({slug('p_name')}, ''), 'unknown_crop') AS name_slug,
        coalesce(nullif({slug('p_type')}, ''), 'unknown_crop') AS type_slug, {slug('p_brand')} AS brand_norm,
        upper(p_brand) AS brand_display, lower(p_type) AS type_lookup FROM part"""

    q["alias_standardize"] = """SELECT TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS "timestamp",
        CASE WHEN lower(trim(event_type)) = '' THEN 'mixed_crop' ELSE lower(trim(event_type)) END AS crop_type,
        round(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE), 6) AS indoor_temperature_c,
        round(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 6) AS humidity_pct,
        round(CAST(user_id AS DOUBLE), 6) AS batch_no FROM events"""

    q["union_by_name"] = with_(OBS) + f"""SELECT crop_type, "timestamp", {r('indoor_temperature_c', 'indoor_temperature_c')},
          {r('humidity_pct', 'humidity_pct')}, CAST(NULL AS DOUBLE) AS n_orders FROM obs
        UNION ALL
        SELECT o_orderpriority, o_orderdate, {r('sum(o_totalprice)', 'indoor_temperature_c')}, NULL,
          CAST(count(*) AS DOUBLE) FROM orders GROUP BY o_orderpriority, o_orderdate"""

    feats_r = ", ".join(r(c, c) for c in FEATS)
    q["dedupe_first"] = with_(OBS_TWICE, DEDUP) + f'SELECT crop_type, "timestamp", {feats_r} FROM dedup'
    q["interpolate_linear"] = with_(OBS_BLANK, DEDUP, RANKED, *interp_ctes("ranked", "interp", FEATS)) + \
        f'SELECT crop_type, "timestamp", {b("_pos", "row_pos")}, {feats_r} FROM interp'
    q["impute_median"] = with_(OBS_BLANK, DEDUP, "gm AS (SELECT crop_type, " + ", ".join(
        f"median({c}) AS m_{c}" for c in FEATS) + " FROM dedup GROUP BY crop_type)") + \
        'SELECT crop_type, "timestamp", ' + ", ".join(r(f"coalesce({c}, m_{c})", c) for c in FEATS) + \
        " FROM dedup JOIN gm USING (crop_type)"
    q["global_median_fill"] = with_(OBS_BLANK, DEDUP, "gm AS (SELECT " + ", ".join(
        f"median({c}) AS m_{c}" for c in FEATS) + " FROM dedup)") + \
        'SELECT crop_type, "timestamp", ' + ", ".join(r(f"coalesce({c}, m_{c})", c) for c in FEATS) + \
        " FROM dedup, gm"

    li = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    q["clip_quantile"] = with_("b AS (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in li) + " FROM lineitem)") + \
        "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag, " + ", ".join(
            r(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, lo_{c}), hi_{c}) END", c) for c in li) + \
        " FROM lineitem, b"

    q["clean_dataset"] = _event_sql(CLEAN, f'SELECT crop_type, "timestamp", {b("_pos", "row_pos")}, {feats_r} FROM cleaned')

    ocols = ["indoor_temperature_c", "n_orders"]
    q["order_series_clean"] = with_(
        """osrc AS (SELECT o_orderpriority AS crop_type, o_orderdate AS "timestamp",
               sum(o_totalprice) AS indoor_temperature_c, CAST(count(*) AS DOUBLE) AS n_orders
             FROM orders GROUP BY o_orderpriority, o_orderdate)""",
        """oranked AS (SELECT *, row_number() OVER (PARTITION BY crop_type ORDER BY "timestamp") AS _pos,
               count(*) OVER (PARTITION BY crop_type) AS _n FROM osrc)""",
        *clean_ctes("oranked", ocols)) + \
        f'SELECT crop_type, "timestamp", {b("_pos", "row_pos")}, ' + ", ".join(r(c, c) for c in ocols) + " FROM cleaned"

    q["export_roundtrip"] = _event_sql(CLEAN, f"""SELECT crop_type, "timestamp", {b('_pos', 'row_pos')}, {feats_r},
        trim(regexp_replace(lower(trim(crop_type)), '[^a-z0-9]+', '_', 'g'), '_') AS key_slug FROM cleaned""")
    sacts = """sacts AS (SELECT event_type AS crop_type, CAST(ts AS TIMESTAMP) AS ts, event_id,
        value AS predicted_temperature_c FROM events)"""
    q["stream_control"] = with_(sacts) + f"""SELECT crop_type, ts, event_id, {r('predicted_temperature_c', 'reading')},
        {_act(0)} AS action, {b(_act(1), 'fan_on')}, {b(_act(2), 'spray_on')}, {_act(3)} AS status_note FROM sacts"""
    q["stream_window_counts"] = with_(sacts) + f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
        time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, crop_type,
        {b('count(*)', 'total_records')}, {b(f'sum({_act(1)})', 'fan_on_events')},
        {b(f'sum({_act(2)})', 'spray_on_events')}, {b(f"count(*) FILTER (WHERE {_act(0)} = 'fan_and_spray_on')", 'fan_and_spray_events')},
        {b(f"count(*) FILTER (WHERE {_act(0)} = 'idle')", 'idle_events')}
        FROM sacts GROUP BY 1, 2, 3"""
    q["knn_forecast"] = _event_sql(CLEAN + SCALE + WINDOWS + _knn_ctes(), f"""SELECT crop_type, "timestamp", split,
        'knn_regressor' AS model, {r('first(y_q)', 'y')},
        {r('CASE WHEN count(*) FILTER (WHERE dist = 0) > 0 THEN avg(y_f) FILTER (WHERE dist = 0) '
           'ELSE sum(y_f / dist) FILTER (WHERE dist <> 0) / sum(1.0 / dist) FILTER (WHERE dist <> 0) END', 'yhat')}
        FROM knn_top GROUP BY crop_type, "timestamp", split""")
    q["external_predictions"] = _event_sql(CLEAN + SCALE + WINDOWS + PREDS, f"""SELECT crop_type, "timestamp", split,
        'external_persistence' AS model, {r('y', 'y')}, {r('yhat', 'yhat')} FROM preds WHERE model = 'naive_persistence'""")
    q["model_registry_notes"] = _event_sql(CLEAN + SCALE + WINDOWS + PREDS + WEIGHTS, f"""
        SELECT k.crop_type, m.model, {b('coalesce(p.n, 0)', 'n_predictions')}, {b('coalesce(p.n_bad, 0)', 'n_bad')},
          CASE WHEN p.n IS NULL THEN 'no predictions' WHEN w.model IS NULL THEN 'refused by the ensemble' ELSE 'in use' END AS note
        FROM (SELECT DISTINCT crop_type FROM cleaned) k
        CROSS JOIN (VALUES ('naive_persistence'), ('linear_baseline')) m(model)
        LEFT JOIN (SELECT crop_type, model, n_val + n_test AS n, n_bad FROM per) p ON p.crop_type = k.crop_type AND p.model = m.model
        LEFT JOIN weights w ON w.crop_type = k.crop_type AND w.model = m.model""")
    q["key_eligibility"] = f"""WITH s AS (SELECT CAST(user_id AS VARCHAR) AS crop_type, count(*) AS n FROM events GROUP BY 1),
        k AS (SELECT *, greatest(1, least(CAST(floor(n * {1.0 - TEST_RATIO!r}::DOUBLE) AS BIGINT), n - 1)) AS k FROM s),
        t AS (SELECT *, greatest(k - {L}, 0) AS tr, greatest(n - k - {L}, 0) AS te FROM k)
        SELECT crop_type, {b('n', 'samples_total')}, {b('tr', 'train_sequences')}, {b('te', 'test_sequences')},
          CASE WHEN n < 12 THEN printf('%d rows, 12 needed', n) WHEN tr < 3 THEN printf('%d training windows, 3 needed', tr)
               WHEN te < 1 THEN 'no test window' END AS reason FROM t"""
    preds3 = [c.replace("preds AS (", "made AS (", 1) for c in PREDS] + ["""preds AS (SELECT * FROM made UNION ALL
        SELECT crop_type, "timestamp", split, 'external_mean' AS model, first(y), avg(yhat) FROM made GROUP BY crop_type, "timestamp", split)"""]
    q["external_ensemble"] = _event_sql(CLEAN + SCALE + WINDOWS + preds3 + WEIGHTS, f"""SELECT crop_type, model,
        {r('validation_rmse', 'validation_rmse')}, {r('score', 'score')}, {r('weight', 'weight')} FROM weights""")
    k_of = "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)"
    q["raw_ingest"] = f"""SELECT lower(event_type) AS crop_type, CAST(date_trunc('second', ts) AS TIMESTAMP) AS "timestamp",
          {r('value', 'indoor_temperature_c')}, {r(k_of, 'humidity_pct')} FROM events WHERE event_id % 4 = 0
        UNION ALL SELECT lower(event_type), CAST(ts AS TIMESTAMP),
          round(CASE WHEN {k_of} >= {EVENT_INVALID_CODE} THEN NULL ELSE value END, 6), round({k_of}, 6) FROM events WHERE event_id % 4 = 1
        UNION ALL SELECT 'ladysfinger', TIMESTAMP '2025-01-01' + to_hours(row_number() OVER (ORDER BY event_id) - 1), round(value, 6), NULL
        FROM events WHERE event_id % 4 = 2
        UNION ALL SELECT lower(event_type), TIMESTAMP '2025-01-01' + to_seconds(event_id * 10800), round(value, 6), round({k_of}, 6)
        FROM events WHERE event_id % 4 = 3"""
    q["json_documents"] = f"""SELECT event_type AS name, CASE WHEN ok THEN event_type END AS crop_type,
          CAST(CASE WHEN ok THEN n ELSE -1 END AS BIGINT) AS rows, CASE WHEN ok THEN round(total, 6) END AS total,
          CAST(CASE WHEN ok THEN n_codes ELSE -1 END AS BIGINT) AS n_codes, NOT ok AS broken
        FROM (SELECT event_type, event_type <> 'error' AS ok, count(*) AS n,
            CAST(sum(CAST(round(value, 2) AS DECIMAL(18, 2))) AS DOUBLE) AS total,
            count(DISTINCT TRY_CAST(json_extract_string(props, '$.k') AS INT)) AS n_codes FROM events GROUP BY event_type)"""
    paged = """paged AS (SELECT fc.*, action, fan_on, spray_on, (row_number() OVER (PARTITION BY crop_type ORDER BY "timestamp") - 1) AS place
        FROM fc JOIN acts USING (crop_type, "timestamp"))""".replace("fc.*", 'fc.crop_type, fc."timestamp", actual_temperature_c, fc.predicted_temperature_c, absolute_error_c')
    best_one = """best1 AS (SELECT crop_type, arg_min(model, "rank") AS best_model FROM cmp GROUP BY crop_type)"""
    iso = """CASE WHEN microsecond("timestamp") % 1000000 = 0 THEN strftime("timestamp", '%Y-%m-%dT%H:%M:%S')
        ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') END"""
    q["payload_rows"] = _event_sql(FULL + ACTIONS + CMP + LABEL + [paged, best_one], f"""SELECT p.crop_type, {b('place // 500', 'page')},
        l.model_coordination, best_model, {b('place % 500', 'row_pos')}, {iso} AS timestamps,
        round_even(actual_temperature_c, 4) AS actual_temperature_c, round_even(predicted_temperature_c, 4) AS predicted_temperature_c,
        round_even(absolute_error_c, 4) AS absolute_error_c, action AS actions, {b('fan_on', 'fan_on')}, {b('spray_on', 'spray_on')}
        FROM paged p JOIN lbl l USING (crop_type) JOIN best1 USING (crop_type)""")
    q["bundle_rows"] = _event_sql(FULL + ACTIONS + [paged], f"""SELECT p.crop_type, upper(p.crop_type) AS crop_label,
        {b('max(place // 500) OVER (PARTITION BY p.crop_type) + 1', 'pages')}, {b('place // 500', 'page')}, {b('place % 500', 'row_pos')},
        {iso} AS timestamps, action AS actions, round_even(predicted_temperature_c, 4) AS predicted_temperature_c, {r('m.rmse', 'rmse')}
        FROM paged p JOIN (SELECT crop_type, sqrt(avg((actual_temperature_c - predicted_temperature_c)
             * (actual_temperature_c - predicted_temperature_c))) AS rmse FROM fc GROUP BY crop_type) m USING (crop_type)""")
    q["linear_regression_normal"] = _event_sql(CLEAN + SCALE + WINDOWS, f"""SELECT crop_type, CAST(slot AS BIGINT) AS slot, 0.0::DOUBLE AS moment
        FROM (SELECT DISTINCT crop_type FROM wins), range({L * len(FEATS) + 1}) s(slot)""")
    wins = CLEAN + SCALE + WINDOWS
    fit_keys = f"SELECT crop_type, {b('count(*) FILTER (WHERE is_fit)', 'fit_windows')} FROM wins GROUP BY crop_type"
    q["boosting_loss"] = _event_sql(wins, f"""SELECT crop_type, model, fit_windows, TRUE AS falls FROM ({fit_keys}),
        (VALUES ('gradient_boosting'), ('xgboost')) m(model)""")
    q["model_rows"] = _event_sql(wins + PREDS[:1], f"""SELECT crop_type, split, m.model, {b('count(*)', 'n')}, {b('0', 'unusual')}
        FROM scored, (VALUES ('random_forest'), ('gradient_boosting'), ('xgboost'), ('svr_rbf')) m(model)
        GROUP BY crop_type, split, m.model""")
    q["kernel_first_order"] = _event_sql(wins, """SELECT crop_type, CAST(slot AS BIGINT) AS slot, 0.0::DOUBLE AS moment
        FROM (SELECT DISTINCT crop_type FROM wins), range(257) t(slot)""")
    q["knn_recall"] = _event_sql(wins + PREDS[:1], f"""SELECT crop_type, {b('7 * count(*)', 'neighbours')}, TRUE AS recall_ok
        FROM scored GROUP BY crop_type""")
    q["importance_shares"] = _event_sql(wins, f"""SELECT DISTINCT crop_type, {b(str(L * len(FEATS)), 'features')},
        1.0::DOUBLE AS total, {b('0', 'negative')} FROM wins""")
    q["stored_models_match"] = _event_sql(wins + PREDS[:1], f"""SELECT crop_type, split, m.model, {b('count(*)', 'n')}, 0.0::DOUBLE AS worst
        FROM scored, (VALUES ('linear_regression'), ('gradient_boosting'), ('xgboost'), ('svr_rbf')) m(model)
        GROUP BY crop_type, split, m.model""")
    q["all_models_ensemble"] = _event_sql(wins, f"""SELECT crop_type, {b('5', 'models')}, 1.0::DOUBLE AS total, {b('0', 'outside')},
        {b('6', 'ranked')}, {b('0', 'unscored')}, {b("count(*) FILTER (WHERE split = 'test')", 'forecast_rows')}
        FROM wins GROUP BY crop_type""")
    q["forest_bounds"] = _event_sql(CLEAN + SCALE + WINDOWS + PREDS[:1], f"""SELECT crop_type, split, {b('count(*)', 'n')},
        CAST(0 AS BIGINT) AS outside FROM scored GROUP BY crop_type, split""")
    q["stream_dedupe"] = f"""SELECT event_type AS crop_type, CAST(ts AS TIMESTAMP) AS ts, event_id, {r('value', 'reading')} FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts, event_id) = 1"""
    t = "indoor_temperature_c"
    q["plot_tables"] = _event_sql(FULL + CMP + ACTIONS + [rank_sql], f"""
        SELECT 'temperature_trend' AS chart, crop_type, "timestamp", '{t}' AS label, {r(t, 'value')} FROM cleaned
        UNION ALL SELECT 'before_scaling', crop_type, "timestamp", '{t}', {r(t, 'value')} FROM cleaned
        UNION ALL SELECT 'after_scaling', crop_type, "timestamp", '{t}', {r(t, 'value')} FROM scaled
        UNION ALL SELECT 'actual_vs_predicted', crop_type, "timestamp", 'actual', {r('actual_temperature_c', 'value')} FROM fc
        UNION ALL SELECT 'actual_vs_predicted', crop_type, "timestamp", 'predicted', {r('predicted_temperature_c', 'value')} FROM fc
        UNION ALL SELECT 'model_rmse_by_key', crop_type, CAST(NULL AS TIMESTAMP), model, {r('rmse', 'value')} FROM cmp
        UNION ALL SELECT 'model_rmse_overall', CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP), model, {r('rmse', 'value')} FROM ovr
        UNION ALL SELECT 'action_fan', crop_type, "timestamp", action, {r('fan_on', 'value')} FROM acts
        UNION ALL SELECT 'action_spray', crop_type, "timestamp", action, {r('spray_on', 'value')} FROM acts""")
    q["correlation_matrix"] = _event_sql(CLEAN, f"""SELECT crop_type, 'indoor_temperature_c' AS feature_a,
        'humidity_pct' AS feature_b, {r('corr(indoor_temperature_c, humidity_pct)', '"corr"')}
        FROM cleaned GROUP BY crop_type""")

    q["min_group_filter"] = _event_sql(CLEAN + SCALE[:1], f"SELECT crop_type, {b('max(_n)', 'samples_total')} FROM grp GROUP BY crop_type")
    q["minmax_fit"] = _event_sql(CLEAN + SCALE, " UNION ALL ".join(
        f"SELECT crop_type, '{c}' AS feature, {r(c + '__min', 'min_val')}, {r(c + '__max', 'max_val')} FROM params"
        for c in FEATS))
    q["minmax_scale"] = _event_sql(CLEAN + SCALE, f'SELECT crop_type, "timestamp", {feats_r} FROM scaled')
    q["minmax_inverse"] = _event_sql(CLEAN + SCALE, f"""SELECT s.crop_type, s."timestamp",
        {r('s.indoor_temperature_c * (p.indoor_temperature_c__max - p.indoor_temperature_c__min) + p.indoor_temperature_c__min', 'restored_temperature_c')}
        FROM scaled s JOIN params p USING (crop_type)""")
    gcols = ", ".join(
        r(f"CASE WHEN mx_{c} = mn_{c} THEN 0.0 ELSE ({c} - mn_{c}) / (mx_{c} - mn_{c}) END", c) for c in FEATS)
    q["global_scale"] = _event_sql(CLEAN + ["gp AS (SELECT " + ", ".join(
        f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in FEATS) + " FROM cleaned)"],
        f'SELECT crop_type, "timestamp", {gcols} FROM cleaned, gp')
    lcols = ", ".join(r(f"CASE WHEN mx_{c} = mn_{c} THEN 0.0 ELSE ({c} - mn_{c}) / (mx_{c} - mn_{c}) END", c)
                      for c in li)
    q["lineitem_scale"] = with_("lp AS (SELECT l_returnflag, " + ", ".join(
        f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in li) + " FROM lineitem GROUP BY l_returnflag)") + \
        f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag, {lcols} " \
        "FROM lineitem JOIN lp USING (l_returnflag)"
    q["chrono_split"] = _event_sql(CLEAN + SCALE + WINDOWS[:1], f"""SELECT crop_type, "timestamp", {b('_pos', 'row_pos')},
        CASE WHEN _pos <= _k THEN 'train' ELSE 'test' END AS split FROM splitted""")
    nx = L * len(FEATS)
    xr = ", ".join(r(f"x{i + 1:02d}", f"x{i + 1:02d}") for i in range(nx))
    q["sliding_windows"] = _event_sql(CLEAN + SCALE + WINDOWS, f"""SELECT crop_type, "timestamp", split,
        {b('win', 'win')}, {xr}, {r('y', 'y')} FROM wins""")
    long = 168
    f32 = {c: f"CAST(CAST({fz(c)} AS FLOAT) AS DOUBLE)" for c in FEATS}
    span = f"OVER (PARTITION BY crop_type ORDER BY _pos ROWS BETWEEN {long} PRECEDING AND 1 PRECEDING)"
    q["long_windows"] = _event_sql(CLEAN + [c.replace("_n >= 12", f"_n >= {long + 6}") for c in SCALE] + WINDOWS[:1], f"""
        SELECT crop_type, "timestamp", split, {b('win', 'win')}, {b(str(long * len(FEATS)), 'slots')}, round(oldest, 4) AS oldest,
          round(newest, 4) AS newest, {', '.join(f'round(sum_{c}, 4) AS sum_{c}' for c in FEATS)}, round(y, 4) AS y,
          in_train AND (n_tr < 5 OR win <= n_tr - greatest(1, CAST(floor(n_tr * {VALIDATION_RATIO!r}::DOUBLE) AS BIGINT))) AS is_fit,
          in_train AND (n_tr < 5 OR win > n_tr - greatest(1, CAST(floor(n_tr * {VALIDATION_RATIO!r}::DOUBLE) AS BIGINT))) AS is_val
        FROM (SELECT *, _pos <= _k AS in_train, CASE WHEN _pos <= _k THEN 'train' ELSE 'test' END AS split,
            CASE WHEN _pos <= _k THEN _pos - {long} ELSE _pos - _k - {long} END AS win, greatest(_k - {long}, 0) AS n_tr,
            first_value({f32['indoor_temperature_c']}) {span} AS oldest, last_value({f32['indoor_temperature_c']}) {span} AS newest,
            {', '.join(f'sum({f32[c]}) {span} AS sum_{c}' for c in FEATS)}, {f32['indoor_temperature_c']} AS y FROM splitted)
        WHERE win >= 1""")
    q["fit_val_split"] = _event_sql(CLEAN + SCALE + WINDOWS, f"""SELECT crop_type,
        {b("count(*) FILTER (WHERE split = 'train')", 'train_sequences')},
        {b("count(*) FILTER (WHERE split = 'test')", 'test_sequences')},
        {b('count(*) FILTER (WHERE is_fit)', 'fit_windows')}, {b('count(*) FILTER (WHERE is_val)', 'val_windows')}
        FROM wins GROUP BY crop_type""")

    pred_cols = f'crop_type, "timestamp", split, model, {r("y", "y")}, {r("yhat", "yhat")}'
    base = CLEAN + SCALE + WINDOWS + PREDS
    q["persistence_forecast"] = _event_sql(base, f"SELECT {pred_cols} FROM preds WHERE model = 'naive_persistence'")
    q["ar1_forecast"] = _event_sql(base, f"SELECT {pred_cols} FROM preds WHERE model = 'linear_baseline'")
    q["stored_linear_forecast"] = q["ar1_forecast"]
    q["validation_rmse"] = _event_sql(base, f"""SELECT crop_type, model,
        {r('sqrt(avg(power(y - yhat, 2)))', 'validation_rmse')} FROM preds WHERE split = 'val' GROUP BY crop_type, model""")
    q["ensemble_weights"] = _event_sql(base + WEIGHTS, f"""SELECT crop_type, model, {r('validation_rmse', 'validation_rmse')},
        {r('score', 'score')}, {r('weight', 'weight')} FROM weights""")
    fc_cols = f"""crop_type, "timestamp", {r('actual_temperature_c', 'actual_temperature_c')},
        {r('predicted_temperature_c', 'predicted_temperature_c')}, {r('absolute_error_c', 'absolute_error_c')}"""
    q["hybrid_forecast"] = _event_sql(FULL, f"SELECT {fc_cols} FROM fc")
    q["stream_forecast"] = q["hybrid_forecast"]
    q["coordination_label"] = _event_sql(FULL + LABEL, "SELECT crop_type, model_coordination FROM lbl")
    q["regression_metrics"] = _event_sql(FULL, f"""SELECT crop_type, {metric_sql('actual_temperature_c', 'predicted_temperature_c')}
        FROM fc GROUP BY crop_type""")
    cmp_cols = f"""crop_type, {b('"rank"', '"rank"')}, model, {r('mae', 'mae')}, {r('rmse', 'rmse')}, {r('r2', 'r2')}"""
    q["model_comparison"] = _event_sql(FULL + CMP, f"SELECT {cmp_cols} FROM cmp")
    ovr_cols = f"""{b('"rank"', '"rank"')}, model, {r('mae', 'mae')}, {r('rmse', 'rmse')}, {r('r2', 'r2')}"""
    q["overall_ranking"] = _event_sql(FULL + CMP + [rank_sql], f"SELECT {ovr_cols} FROM ovr")
    q["top_ranking"] = _event_sql(FULL + CMP + [rank_sql], f'SELECT {ovr_cols} FROM ovr ORDER BY "rank" LIMIT 5')
    best_sql = """best AS (SELECT crop_type, arg_min(model, "rank") AS best_model, arg_min(rmse, "rank") AS best_model_rmse,
        count(*) AS models_evaluated FROM cmp GROUP BY crop_type)"""
    q["best_model"] = _event_sql(FULL + CMP + [best_sql], f"""SELECT crop_type, best_model,
        {r('best_model_rmse', 'best_model_rmse')}, {b('models_evaluated', 'models_evaluated')} FROM best""")
    q["threshold_actions"] = _event_sql(FULL + ACTIONS, f"""SELECT "timestamp", crop_type,
        {r('predicted_temperature_c', 'predicted_temperature_c')}, action, {b('fan_on', 'fan_on')},
        {b('spray_on', 'spray_on')}, status_note FROM acts""")
    summ_sql = """summ AS (SELECT crop_type, count(*) AS total_records, sum(fan_on) AS fan_on_events,
        sum(spray_on) AS spray_on_events, count(*) FILTER (WHERE action = 'fan_and_spray_on') AS fan_and_spray_events,
        count(*) FILTER (WHERE action = 'idle') AS idle_events FROM acts GROUP BY crop_type)"""
    summ_cols = ", ".join(b(c, c) for c in ("total_records", "fan_on_events", "spray_on_events",
                                             "fan_and_spray_events", "idle_events"))
    q["control_summary"] = _event_sql(FULL + ACTIONS + [summ_sql], f"SELECT crop_type, {summ_cols} FROM summ")
    perf_sql = f"""perf AS (SELECT crop_type, avg(abs(actual_temperature_c - predicted_temperature_c)) AS mae,
        sqrt(avg(power(actual_temperature_c - predicted_temperature_c, 2))) AS rmse,
        coalesce(avg(CASE WHEN abs(actual_temperature_c) > 1e-8
                     THEN abs((actual_temperature_c - predicted_temperature_c) / actual_temperature_c) END) * 100.0, 0.0) AS mape_pct,
        CASE WHEN count(*) * var_pop(actual_temperature_c) = 0 THEN 0.0
             ELSE 1.0 - sum(power(actual_temperature_c - predicted_temperature_c, 2)) / (count(*) * var_pop(actual_temperature_c)) END AS r2,
        count(*) AS sample_count FROM fc GROUP BY crop_type)"""
    q["crop_results"] = _event_sql(FULL + ACTIONS + CMP + LABEL + [best_sql, summ_sql, perf_sql], f"""
        SELECT w.crop_type, {b('w.train_sequences', 'train_sequences')}, {b('w.test_sequences', 'test_sequences')},
          {b('g.samples_total', 'samples_total')}, l.model_coordination, bs.best_model,
          {r('bs.best_model_rmse', 'best_model_rmse')}, {b('bs.models_evaluated', 'models_evaluated')},
          {r('p.mae', 'mae')}, {r('p.rmse', 'rmse')}, {r('p.mape_pct', 'mape_pct')}, {r('p.r2', 'r2')},
          {b('p.sample_count', 'sample_count')}, {summ_cols.replace('CAST(', 'CAST(s.')},
          'indoor_temperature_c' AS target_column
        FROM (SELECT crop_type, count(*) FILTER (WHERE split = 'train') AS train_sequences,
                     count(*) FILTER (WHERE split = 'test') AS test_sequences FROM wins GROUP BY crop_type) w
        JOIN (SELECT crop_type, max(_n) AS samples_total FROM grp GROUP BY crop_type) g USING (crop_type)
        JOIN lbl l USING (crop_type) JOIN best bs USING (crop_type) JOIN perf p USING (crop_type)
        JOIN summ s USING (crop_type)""")
    q["performance_report"] = _event_sql(FULL + LABEL + [perf_sql], f"""SELECT p.crop_type, {r('p.mae', 'mae')},
        {r('p.rmse', 'rmse')}, {r('p.mape_pct', 'mape_pct')}, {r('p.r2', 'r2')}, {b('p.sample_count', 'sample_count')},
        l.model_coordination AS backend,
        printf('%s: off by %.4f on average (root mean square %.4f, %.2f percent), r2 %.4f over %d rows', p.crop_type, p.mae, p.rmse,
               p.mape_pct, p.r2, p.sample_count) AS report_line
        FROM perf p LEFT JOIN lbl l USING (crop_type)""")
    q["dataset_summary"] = _event_sql(FULL, _summary_sql())
    q["run_status"] = _event_sql(FULL, f"""SELECT {b('(SELECT count(DISTINCT crop_type) FROM cleaned)', 'keys_exported')},
        {b('(SELECT count(DISTINCT crop_type) FROM grp)', 'keys_discovered')},
        {b('(SELECT count(DISTINCT crop_type) FROM fc)', 'keys_processed')}""")
    q["prediction_pivot"] = _event_sql(FULL, f"""SELECT {fc_cols},
        {r("(SELECT o.yhat FROM orig o WHERE o.crop_type = fc.crop_type AND o.\"timestamp\" = fc.\"timestamp\" AND o.model = 'linear_baseline')", 'pred_linear_baseline_c')},
        {r("(SELECT o.yhat FROM orig o WHERE o.crop_type = fc.crop_type AND o.\"timestamp\" = fc.\"timestamp\" AND o.model = 'naive_persistence')", 'pred_naive_persistence_c')}
        FROM fc""")
    q["last_k_rows"] = _event_sql(FULL + ACTIONS, f"""SELECT {fc_cols}, action, {b('rn', 'recent_rank')} FROM (
        SELECT fc.crop_type, fc."timestamp", actual_temperature_c, fc.predicted_temperature_c, absolute_error_c, action, row_number() OVER (PARTITION BY crop_type ORDER BY "timestamp" DESC) AS rn
        FROM fc JOIN acts USING (crop_type, "timestamp")) WHERE rn <= 8""")
    q["last_k_rows_at_step"] = _event_sql(FULL + ACTIONS, f"""SELECT {fc_cols}, action,
        {b('row_number() OVER (PARTITION BY crop_type ORDER BY "timestamp" DESC)', 'recent_rank')} FROM (
        SELECT fc.crop_type, fc."timestamp", actual_temperature_c, fc.predicted_temperature_c, absolute_error_c, action,
               row_number() OVER (PARTITION BY crop_type ORDER BY "timestamp") AS step
        FROM fc JOIN acts USING (crop_type, "timestamp")) WHERE step <= 100
        QUALIFY row_number() OVER (PARTITION BY crop_type ORDER BY "timestamp" DESC) <= 8""")
    q["hybrid_gain"] = _event_sql(FULL + CMP, f"""SELECT s.crop_type, s.best_single_model,
        {r('s.best_single_rmse', 'best_single_rmse')}, {r('h.rmse', 'hybrid_rmse')},
        {r('s.best_single_rmse - h.rmse', 'hybrid_gain')}
        FROM (SELECT crop_type, arg_min(model, (rmse, model)) AS best_single_model, min(rmse) AS best_single_rmse
              FROM cmp WHERE lower(model) <> 'hybrid_coordinated' GROUP BY crop_type) s
        JOIN (SELECT crop_type, rmse FROM cmp WHERE lower(model) = 'hybrid_coordinated') h USING (crop_type)""")
    q["dashboard_metrics"] = _event_sql(FULL + [perf_sql], f"""SELECT upper(k.crop_type) AS crop_label, k.crop_type,
        {r('p.mae', 'mae')}, {r('p.rmse', 'rmse')}, {r('p.mape_pct', 'mape_pct')}, {r('p.r2', 'r2')}
        FROM (SELECT DISTINCT crop_type FROM grp) k LEFT JOIN perf p ON lower(k.crop_type) = lower(p.crop_type)""")
    q["plot_series"] = _event_sql(FULL, f"""SELECT crop_type, "timestamp", 'actual' AS series, {r('y', 'value')}
        FROM orig WHERE model = 'hybrid_coordinated'
        UNION ALL SELECT crop_type, "timestamp", model AS series, {r('yhat', 'value')} FROM orig""")
    for exported, source in (("scaled_export", "minmax_scale"), ("params_export", "minmax_fit"), ("actions_export", "threshold_actions"),
                             ("predictions_export", "prediction_pivot")):
        q[exported] = q[source]
    slots = [f"x{i + 1:02d}" for i in range(L * len(FEATS))]
    q["windows_export"] = _event_sql(CLEAN + SCALE + WINDOWS, f"""SELECT crop_type, "timestamp", split, {b('win', 'win')},
        {b(str(len(slots)), 'slots')}, {r(' + '.join(['0.0', *slots]), 'total')}, {r('y', 'y')} FROM wins""")
    q["status_text"] = _event_sql(FULL, """SELECT printf('keys: %d found, %d processed, %d exported',
        (SELECT count(DISTINCT crop_type) FROM grp), (SELECT count(DISTINCT crop_type) FROM fc),
        (SELECT count(DISTINCT crop_type) FROM cleaned)) AS line""")
    q["comparison_report_rows"] = _event_sql(FULL + CMP, f"""SELECT crop_type, {b('count(*) OVER (PARTITION BY crop_type) + 1', 'lines')},
        first_value(model) OVER (PARTITION BY crop_type ORDER BY "rank") AS winner,
        {r('first_value(rmse) OVER (PARTITION BY crop_type ORDER BY "rank")', 'winner_rmse')}, {b('"rank"', 'place')}, model,
        {r('rmse', 'rmse')}, {r('mae', 'mae')}, {r('r2', 'r2')} FROM cmp""")
    q["event_time_counts"], q["event_time_dedupe"] = q["stream_window_counts"], q["stream_dedupe"]
    return q


def _knn_ctes(k: int = 7) -> list[str]:
    n = L * len(FEATS)
    xs = [f"x{i + 1:02d}" for i in range(n)]
    mom = ", ".join(f"avg({x}) AS m_{x}, CASE WHEN stddev_pop({x}) IS NULL OR stddev_pop({x}) = 0 THEN 1.0 "
                    f"ELSE stddev_pop({x}) END AS s_{x}" for x in xs)
    zf = ", ".join(f"(w.{x} - m.m_{x}) / m.s_{x} AS z_{x}" for x in xs)
    dist = " + ".join(f"(q.z_{x} - f.z_{x}) * (q.z_{x} - f.z_{x})" for x in xs)
    return [
        f"kmom AS (SELECT crop_type, {mom} FROM wins WHERE is_fit GROUP BY crop_type)",
        f"kfit AS (SELECT w.crop_type, w._pos AS fid, w.y AS y_f, {zf} FROM wins w JOIN kmom m USING (crop_type) WHERE w.is_fit)",
        f"""kq AS (SELECT w.crop_type, w."timestamp", 'val' AS split, w.y AS y_q, {zf} FROM wins w JOIN kmom m USING (crop_type) WHERE w.is_val
               UNION ALL
               SELECT w.crop_type, w."timestamp", 'test' AS split, w.y AS y_q, {zf} FROM wins w JOIN kmom m USING (crop_type) WHERE w.split = 'test')""",
        f"""knn_top AS (SELECT q.crop_type, q."timestamp", q.split, q.y_q, f.fid, f.y_f, sqrt({dist}) AS dist
               FROM kq q JOIN kfit f USING (crop_type)
               QUALIFY row_number() OVER (PARTITION BY q.crop_type, q."timestamp", q.split ORDER BY sqrt({dist}), f.fid) <= {k})""",
    ]


def _summary_sql() -> str:
    def shape(name, src, ncols):
        return (f"SELECT '{name}_shape' AS section, 'rows' AS \"column\", CAST(count(*) AS DOUBLE) AS value FROM {src} "
                f"UNION ALL SELECT '{name}_shape', 'columns', {float(ncols)}")

    def nulls(name, src, cols):
        parts = []
        for c in cols:
            cond = f'"{c}" IS NULL' if c in ("crop_type", "timestamp") else f"{c} IS NULL OR isnan({c})"
            parts.append(f"SELECT '{name}_missing', '{c}', CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) FROM {src}")
        return " UNION ALL ".join(parts)

    cols = ["crop_type", "timestamp", *FEATS]
    clean_cols = ["timestamp", "crop_type", *FEATS]
    rng = " UNION ALL ".join(
        f"SELECT 'scaled_{s}', '{c}', round_even({s}({c}), 4) FROM scaled" for c in FEATS for s in ("min", "max"))
    body = " UNION ALL ".join([
        shape("raw", "obs", 4), shape("cleaned", "cleaned", 4), shape("selected", "cleaned", 4),
        shape("scaled", "scaled", 4), nulls("raw", "obs", cols), nulls("cleaned", "cleaned", clean_cols), rng])
    return f"SELECT section, \"column\", round(value, 6) AS value FROM ({body})"
