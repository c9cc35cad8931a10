"""Distribution drift and baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.constants import DRIFT_FEATURES, DRIFT_PREDICTIONS
from ebbtide.operators import drift as ops
from ebbtide.operators import metrics
from ebbtide.plans import dashboards, monitoring, scoring
from ebbtide.queries import base_sql as sql
from ebbtide.queries import inputs
from ebbtide.queries.modelling import CUTOFF
from ebbtide.session import materialize
from ebbtide.sources.sample_views import read_table

# Lines shipped before the day are the reference of the line drift; the columns compared.
SHIP_CUT = "1998-07-01"
LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
RUN = "2024-01-31"


def _lines(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS, F.to_date("l_shipdate").alias("day"))
    before = F.col("day") < F.lit(SHIP_CUT).cast("date")
    return lines.filter(before), lines.filter(~before)


def _features(spark, sf_dir):
    feats = inputs.features_table(spark, sf_dir)
    before = F.col("reporting_period") < F.lit(CUTOFF).cast("date")
    return feats, feats.filter(before), feats.filter(~before)


def psi_drift(spark, sf_dir):
    """Every line, before against after the cut."""
    reference, current = _lines(spark, sf_dir)
    return ops.drift_report(reference, current, LINE_COLUMNS, "lines").withColumn("psi", F.round("psi", 9))


def extrapolation_guard(spark, sf_dir):
    _, reference, current = _features(spark, sf_dir)
    row = ops.extrapolation_report(reference, current)
    return row.withColumns({c: F.round(c, 9) for c in ("ref_min", "ref_max", "out_of_range_rate")})


def _report(spark, sf_dir):
    feats, reference, current = _features(spark, sf_dir)
    predictions = inputs.predictions(feats)
    first = predictions.filter(F.col("model_version") == "1")
    return ops.full_report(reference, current, first, metrics.latest_batch(predictions)), predictions


def drift_report(spark, sf_dir):
    report, _ = _report(spark, sf_dir)
    return report.select(
        "drift_type", "feature", F.round("psi", 6).alias("psi"), F.round("out_of_range_rate", 9).alias("out_of_range_rate"), "status"
    )


def drift_report_frozen(spark, sf_dir):
    """The report against baselines frozen as histograms, which are stored first."""
    feats, reference, current = _features(spark, sf_dir)
    predictions = inputs.predictions(feats)
    first = predictions.filter(F.col("model_version") == "1")
    frozen = [
        materialize(ops.freeze_histograms(rows, columns, "1", f"{RUN} 00:00:00"), "frozen")
        for rows, columns in ((reference, DRIFT_FEATURES), (first, DRIFT_PREDICTIONS))
    ]
    report = ops.full_report_frozen(frozen[0], current, frozen[1], metrics.latest_batch(predictions))
    return report.select(
        "drift_type", "feature", F.round("psi", 6).alias("psi"), F.round("out_of_range_rate", 9).alias("out_of_range_rate"), "status"
    )


def alert_summary(spark, sf_dir):
    report, _ = _report(spark, sf_dir)
    row = ops.alert_summary(report)
    return row.select(
        "drift_detected", F.array_join(F.array_sort(F.map_keys("alerts")), ", ").alias("alerted"),
        F.round("max_value", 3).alias("max_value"),
    )


def dash_drift(spark, sf_dir):
    reference, current = _lines(spark, sf_dir)
    report = ops.drift_report(reference, current, LINE_COLUMNS, "lines").withColumn("run_timestamp", F.lit(RUN))
    return dashboards.drift_summary(report).withColumn("psi", F.round("psi", 9))


def retrain_decision(spark, sf_dir):
    """Drift report and newest batch -> retrain or not, and why."""
    report, predictions = _report(spark, sf_dir)
    row = monitoring.retraining_decision(report, metrics.monitoring_metrics(metrics.latest_batch(predictions)))
    return row.select("drift_detected", F.round("max_null_rate", 6).alias("max_null_rate"), "retrain", "reason")


def baseline_freeze(spark, sf_dir):
    return ops.freeze_baseline(inputs.features(spark, sf_dir), "4", "2024-03-01 00:00:00").withColumn(
        "baseline_frozen_at", F.date_format("baseline_frozen_at", "yyyy-MM-dd")
    )


def _baselines(feats):
    """Baselines of versions 1 and 2; version 3, which serves, has none."""
    kept = [
        ops.freeze_baseline(feats.filter(F.col("product") <= p), v, stamp)
        for v, stamp, p in (("1", "2024-01-01 00:00:00", "Z"), ("2", "2024-02-01 00:00:00", "FURNITURE"))
    ]
    return materialize(kept[0].unionByName(kept[1]), "baselines")


def baseline_lookup(spark, sf_dir):
    """The baseline the newest batch is compared with: its own, else the newest."""
    feats = inputs.features_table(spark, sf_dir)
    served = scoring.served_version(inputs.predictions(feats))
    baselines = _baselines(feats)
    missing = ops.baseline_for(baselines, served).withColumn("served", F.lit("3"))
    present = ops.baseline_for(baselines, "1").withColumn("served", F.lit("1"))
    rows = missing.unionByName(present)
    return rows.groupBy("served", "model_version").agg(
        F.count("*").alias("n_rows"), F.sum("n_accounts").alias("n_accounts"), F.max("int_rate").alias("max_rate")
    )


QUERIES = {
    f.__name__: f
    for f in (
        psi_drift, extrapolation_guard, drift_report, drift_report_frozen, alert_summary, dash_drift, retrain_decision, baseline_freeze,
        baseline_lookup,
    )
}


def _long(source: str, columns, where: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {source} WHERE {where} AND {c} IS NOT NULL" for c in columns
    )


def psi_ctes(name: str, columns, reference: str, reference_where: str, current: str, current_where: str) -> list[str]:
    """Edges by rank and linear interpolation, counts by comparison with every edge pair."""
    return [
        f"{name}_ref AS ({_long(reference, columns, reference_where)})",
        f"{name}_cur AS ({_long(current, columns, current_where)})",
        f"""{name}_ranked AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) - 1 AS rn,
  count(*) OVER (PARTITION BY feature) AS n FROM {name}_ref)""",
        f"""{name}_target AS (SELECT feature, n, i, CASE WHEN i = 10 THEN 1.0::DOUBLE ELSE i * 0.1::DOUBLE END * (n - 1) AS pos
  FROM (SELECT feature, max(n) AS n FROM {name}_ranked GROUP BY 1) CROSS JOIN (SELECT range AS i FROM range(0, 11)) t)""",
        f"""{name}_edges AS (SELECT DISTINCT t.feature, a.v + (b.v - a.v) * (t.pos - floor(t.pos)) AS e FROM {name}_target t
  JOIN {name}_ranked a ON a.feature = t.feature AND a.rn = CAST(floor(t.pos) AS BIGINT)
  JOIN {name}_ranked b ON b.feature = t.feature AND b.rn = least(CAST(floor(t.pos) AS BIGINT) + 1, t.n - 1))""",
        f"""{name}_spans AS (SELECT feature, e AS lo, lead(e) OVER s AS hi, lead(e, 2) OVER s IS NULL AS is_last,
  count(*) OVER (PARTITION BY feature) AS n_edges FROM {name}_edges WINDOW s AS (PARTITION BY feature ORDER BY e))""",
        f"""{name}_counts AS (SELECT s.feature, lo, n_edges,
  (SELECT count(*) FROM {name}_ref r WHERE r.feature = s.feature AND v >= lo AND (v < hi OR (is_last AND v = hi))) AS r,
  (SELECT count(*) FROM {name}_cur c WHERE c.feature = s.feature AND v >= lo AND (v < hi OR (is_last AND v = hi))) AS c
  FROM {name}_spans s WHERE hi IS NOT NULL)""",
        f"""{name}_shares AS (SELECT feature, n_edges,
  CASE WHEN r = 0 THEN 0.0001::DOUBLE ELSE r / sum(r) OVER (PARTITION BY feature) END AS rs,
  CASE WHEN c = 0 THEN 0.0001::DOUBLE ELSE c / sum(c) OVER (PARTITION BY feature) END AS cs FROM {name}_counts)""",
        f"""{name} AS (SELECT e.feature, CASE WHEN n < 3 THEN 0 ELSE psi END AS psi
  FROM (SELECT feature, count(*) AS n FROM {name}_edges GROUP BY 1) e
  LEFT JOIN (SELECT feature, sum((cs - rs) * ln(cs / rs)) AS psi FROM {name}_shares GROUP BY 1) s ON s.feature = e.feature)""",
    ]


def _band(value: str) -> str:
    return f"CASE WHEN {value} >= 0.25 THEN 'ALERT' WHEN {value} >= 0.1 THEN 'WARN' ELSE 'OK' END"


_LINES = psi_ctes(
    "line_psi", LINE_COLUMNS, "lineitem", f"l_shipdate::DATE < DATE '{SHIP_CUT}'", "lineitem",
    f"l_shipdate::DATE >= DATE '{SHIP_CUT}'",
)
_BEFORE, _AFTER = f"reporting_period < DATE '{CUTOFF}'", f"reporting_period >= DATE '{CUTOFF}'"
_GUARD = f"""guard AS (SELECT min(delta_to_best_buy) FILTER ({_BEFORE}) AS ref_min,
  max(delta_to_best_buy) FILTER ({_BEFORE}) AS ref_max FROM features),
guarded AS (SELECT ref_min, ref_max, avg(CASE WHEN delta_to_best_buy < ref_min OR delta_to_best_buy > ref_max THEN 1.0 ELSE 0.0 END)
  AS rate FROM features CROSS JOIN guard WHERE {_AFTER} AND delta_to_best_buy IS NOT NULL GROUP BY 1, 2)"""
_FULL = (
    sql.FEATURE_CTES
    + sql.prediction_ctes(inputs.LANDED_UNTIL)
    + psi_ctes("feature_psi", DRIFT_FEATURES, "features", _BEFORE, "features", _AFTER)
    + psi_ctes("pred_psi", DRIFT_PREDICTIONS, "predictions", "model_version = '1'", "predictions", "model_version = '3'")
    + [
        _GUARD,
        f"""report AS (
  SELECT 'feature' AS drift_type, feature, psi, NULL::DOUBLE AS rate, {_band('psi')} AS status FROM feature_psi
  UNION ALL SELECT 'prediction', feature, psi, NULL, {_band('psi')} FROM pred_psi
  UNION ALL SELECT 'extrapolation', 'delta_to_best_buy', NULL, rate, CASE WHEN rate > 0.05 THEN 'ALERT' ELSE 'OK' END FROM guarded)""",
    ]
)

SQL = {
    "psi_drift": sql.with_ctes(
        _LINES, f"SELECT 'lines' AS drift_type, feature, round(psi, 9) AS psi, {_band('psi')} AS status FROM line_psi"
    ),
    "extrapolation_guard": sql.with_ctes(
        sql.FEATURE_CTES + [_GUARD],
        """SELECT 'extrapolation' AS drift_type, 'delta_to_best_buy' AS feature, round(ref_min, 9) AS ref_min,
  round(ref_max, 9) AS ref_max, round(rate, 9) AS out_of_range_rate, CASE WHEN rate > 0.05 THEN 'ALERT' ELSE 'OK' END AS status
FROM guarded""",
    ),
    "drift_report": sql.with_ctes(
        _FULL, "SELECT drift_type, feature, round(psi, 6) AS psi, round(rate, 9) AS out_of_range_rate, status FROM report"
    ),
    "alert_summary": sql.with_ctes(
        _FULL,
        """SELECT bool_or(status = 'ALERT') AS drift_detected,
  coalesce(string_agg(drift_type || '::' || feature, ', ' ORDER BY drift_type || '::' || feature) FILTER (status = 'ALERT'), '') AS alerted,
  max(round(coalesce(psi, rate), 3)) FILTER (status = 'ALERT') AS max_value FROM report""",
    ),
    "dash_drift": sql.with_ctes(
        _LINES,
        f"""SELECT '{RUN}' AS run_timestamp, 'lines' AS drift_type, feature, round(psi, 9) AS psi, {_band('psi')} AS status
FROM line_psi""",
    ),
    "retrain_decision": sql.with_ctes(
        _FULL
        + [
            """per_product AS (SELECT avg(CASE WHEN CAST(balance AS DOUBLE) <> 0 THEN
    abs(CAST(balance AS DOUBLE) - CAST(balance_pred AS DOUBLE)) / abs(CAST(balance AS DOUBLE)) END) * 100 AS mape,
  avg(CASE WHEN balance_pred IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate
  FROM predictions WHERE model_version = '3' GROUP BY product)""",
            """signals AS (SELECT (SELECT bool_or(status = 'ALERT') FROM report) AS drift, max(null_rate) AS nulls,
  avg(mape) AS error FROM per_product)""",
        ],
        """SELECT drift AS drift_detected, round(nulls, 6) AS max_null_rate, drift OR nulls > 0.1 OR error > 20 AS retrain,
  CASE WHEN drift OR nulls > 0.1 OR error > 20 THEN concat_ws('; ', CASE WHEN drift THEN 'PSI alert detected' END,
    CASE WHEN nulls > 0.1 THEN printf('Null prediction rate %.2f%% > threshold 10.00%%', nulls * 100) END,
    CASE WHEN error > 20 THEN printf('Portfolio MAPE %.2f > threshold 20.00', error) END)
  ELSE 'No retraining trigger crossed' END AS reason FROM signals""",
    ),
    "baseline_freeze": sql.with_ctes(
        sql.FEATURE_CTES,
        """SELECT int_rate, best_buy, delta_to_best_buy, tenure_months, n_accounts, '4' AS model_version,
  '2024-03-01' AS baseline_frozen_at FROM features""",
    ),
    "baseline_lookup": sql.with_ctes(
        sql.FEATURE_CTES
        + [
            """baselines AS (SELECT *, '1' AS model_version FROM features
  UNION ALL SELECT *, '2' FROM features WHERE product <= 'FURNITURE')"""
        ],
        """SELECT served, model_version, count(*) AS n_rows, CAST(sum(n_accounts) AS BIGINT) AS n_accounts, max(int_rate) AS max_rate
FROM baselines JOIN (VALUES ('3', '2'), ('1', '1')) v(served, wanted) ON wanted = model_version GROUP BY 1, 2""",
    ),
}
SQL["drift_report_frozen"] = SQL["drift_report"]
