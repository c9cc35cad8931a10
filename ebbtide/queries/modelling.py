"""Split, outliers, spline, fits, ratio tables, search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.constants import FOLD_OFFSETS, PARAM_GRID
from ebbtide.functions import spline
from ebbtide.functions.dates import month_text
from ebbtide.functions.ratios import rate_label, rate_midpoints
from ebbtide.operators import glm, metrics, prep, project, ratio_tables
from ebbtide.plans import training
from ebbtide.queries import base_sql as sql
from ebbtide.queries import inputs
from ebbtide.session import materialize

# The training cut-off and the last cohort evaluated.
CUTOFF = "2000-07-01"
LAST_COHORT = "2000-06-01"
_FLAGS = [f"keep_{c}" for c in prep.RATIO_COLUMNS]


def _cohort_month():
    return month_text(F.col("cohort")).alias("cohort")


def _train_rows(spark, sf_dir, offsets=()):
    """Flagged training rows: the main window, with and without age 2, and the folds asked for."""
    features = inputs.features_table(spark, sf_dir)
    rows = prep.outlier_flags(prep.training_windows(features, CUTOFF, offsets), prep.WINDOW_KEYS)
    return materialize(rows, "train_rows")


def split_train_test(spark, sf_dir):
    rows = prep.split(inputs.features(spark, sf_dir), CUTOFF, drop_month2=True)
    return rows.select(_cohort_month(), "product", "months_since_start", "is_train", "is_test")


def iqr_outliers(spark, sf_dir):
    train = prep.split(inputs.features_table(spark, sf_dir), CUTOFF, drop_month2=True).filter("is_train")
    return prep.outlier_flags(train).select(_cohort_month(), "product", "months_since_start", *_FLAGS)


def rolling_windows(spark, sf_dir):
    """Training rows of each window, month-2 rule and product, and how many each response keeps."""
    rows = _train_rows(spark, sf_dir, FOLD_OFFSETS)
    return rows.groupBy(*prep.WINDOW_KEYS).agg(
        F.count("*").alias("n_rows"),
        F.max("reporting_period").alias("last_period"),
        *[F.count_if(F.col(c)).alias(f"n_{c}") for c in _FLAGS],
    )


def search_grid(spark, sf_dir):
    """Configurations x windows of every product, with the training rows each would use."""
    rows = prep.training_windows(inputs.features(spark, sf_dir), CUTOFF)
    return prep.expand_grid(rows.groupBy(*prep.WINDOW_KEYS).agg(F.count("*").alias("n_rows")))


def bin_representatives(spark, sf_dir):
    train = prep.split(inputs.features(spark, sf_dir), CUTOFF, drop_month2=True).filter("is_train")
    chosen = ratio_tables.representative_deltas(train, ["product"])
    return chosen.select("product", F.posexplode("bin_deltas").alias("bin_id", "delta_to_best_buy")).select(
        "product", "bin_id", rate_label(F.col("bin_id")).alias("rate_bin"),
        F.round("delta_to_best_buy", 9).alias("delta_to_best_buy"),
    )


def prediction_grid(spark, sf_dir):
    train = prep.split(inputs.features(spark, sf_dir), CUTOFF, drop_month2=True).filter("is_train")
    windows = prep.expand_grid(
        ratio_tables.representative_deltas(train.withColumn("drop_month2", F.lit(True)), ["product", "drop_month2"])
    )
    rows = ratio_tables.grid_rows(windows)
    return rows.groupBy("product", "grid_id", "months_since_start").agg(
        F.count("*").alias("n_bins"), F.round(F.min("delta_to_best_buy"), 9).alias("lowest_delta"),
        F.round(F.max("delta_to_best_buy"), 9).alias("highest_delta"),
    )


def spline_basis(spark, sf_dir):
    train = prep.split(inputs.features(spark, sf_dir), CUTOFF).filter("is_train")
    frames = (
        train.groupBy("product")
        .agg(F.array_sort(F.collect_set("months_since_start")).alias("ages"))  # months of a calendar
        .withColumn("knots", spline.knots(F.col("ages")))
        .withColumn("curve", spline.curvature(F.col("knots")))
    )
    ages = frames.select("product", "knots", "curve", F.explode(F.sequence(F.lit(1), F.lit(90))).alias("age"))
    placed = spline.place(ages, F.col("age"), F.col("knots"))
    columns = spline.basis(F.col("age"), F.col("curve"))
    return placed.select("product", "age", *[F.round(c, 9).alias(f"spline_{i + 1}") for i, c in enumerate(columns)])


def _main_models(spark, sf_dir, robust=False, wanted=tuple(glm.RESPONSE_COLUMN)):
    """Models of the main window without age 2; no other rows are written."""
    windows = prep.training_windows(inputs.features_table(spark, sf_dir), CUTOFF, ()).filter(F.col("drop_month2"))
    rows = materialize(prep.outlier_flags(windows, prep.WINDOW_KEYS), "train_rows")
    return glm.fit_responses(rows, robust=robust, wanted=wanted)


def _coefficients(models, response):
    table = glm.coefficient_table(models.filter(F.col("response") == response), ["product"])
    return table.select("product", "term", F.round("coef", 6).alias("coef"))


def glm_outflow(spark, sf_dir):
    return _coefficients(_main_models(spark, sf_dir, wanted=(glm.OUTFLOW,)), glm.OUTFLOW)


def glm_withdrawal(spark, sf_dir):
    return _coefficients(_main_models(spark, sf_dir, wanted=(glm.WITHDRAWAL,)), glm.WITHDRAWAL)


def glm_receipts(spark, sf_dir):
    return _coefficients(_main_models(spark, sf_dir, wanted=(glm.RECEIPTS,)), glm.RECEIPTS)


def glm_robust_se(spark, sf_dir):
    table = glm.coefficient_table(_main_models(spark, sf_dir, robust=True), ["product"])
    return table.select(
        "product", "response", "term", F.round("coef", 6).alias("coef"), F.round("se_hc0", 6).alias("se_hc0")
    )


def glm_diagnostics(spark, sf_dir):
    models = _main_models(spark, sf_dir)
    return models.select(
        "product", "response", "family", "n_used", "n_left_out", "status", F.round("deviance", 4).alias("deviance")
    )


def _main_table(spark, sf_dir):
    """Features and the ratio table of the main window, age 2 left out of training, 60 months."""
    features = inputs.features_table(spark, sf_dir)
    rows = materialize(prep.outlier_flags(prep.training_windows(features, CUTOFF, ()), prep.WINDOW_KEYS), "train_rows")
    rows = rows.filter(F.col("drop_month2"))
    return features, ratio_tables.ratio_tables(glm.fit_responses(rows), rows, [(60, True)])


def fitted_ratios(spark, sf_dir):
    _, table = _main_table(spark, sf_dir)
    rounded = [F.round(c, 6).alias(c) for c in ratio_tables.RATIOS]
    return table.select("product", "months_since_start", "bin_id", *rounded)


def fitted_projection(spark, sf_dir):
    """The months after the cut-off, projected by that table."""
    features, table = _main_table(spark, sf_dir)
    projected = project.score(project.between_periods(features, CUTOFF, None), materialize(table, "ratios"))
    return projected.select(
        _cohort_month(), "product", "months_since_start", "balance",
        *[F.round(c, 2).alias(c) for c in ("balance_pred", "receipts_pred", "withdrawals_pred", "transfers_pred")],
    )


def _training(spark, sf_dir):
    features = inputs.features_table(spark, sf_dir)
    return training.train(features, CUTOFF, LAST_COHORT)


def ratio_table(spark, sf_dir):
    run = _training(spark, sf_dir)
    served = training.served_ratios(run.ratios, run.best)
    rounded = [F.round(c, 6).alias(c) for c in ratio_tables.RATIOS]
    return served.select("product", "months_since_start", "rate_bin", *rounded)


def glm_grid_search(spark, sf_dir):
    trials = _training(spark, sf_dir).trials
    return trials.select(
        "product", "grid_id", "n_folds",
        *[F.round(c, d).alias(c) for c, d in (("val_mape", 4), ("val_rmse", 2), ("cv_mape", 4))],
    )


def best_trained(spark, sf_dir):
    """The winner of the search beside the naive baseline."""
    features = inputs.features_table(spark, sf_dir)
    run = training.train(features, CUTOFF, LAST_COHORT)
    baseline = metrics.naive_baseline(features, F.col("reporting_period") < F.lit(CUTOFF).cast("date"))
    judged = metrics.against_baseline(run.best.withColumnRenamed("val_mape", "mape_balance"), baseline)
    return judged.select("product", "grid_id", F.round("mape_balance", 4).alias("mape_balance"), "beats_baseline")


def trained_scores(spark, sf_dir):
    """End to end: the fitted, selected ratio tables score the months after the cut-off."""
    features = inputs.features_table(spark, sf_dir)
    run = training.train(features, CUTOFF, LAST_COHORT)
    served = training.served_ratios(run.ratios, run.best)
    scored = project.score(project.between_periods(features, CUTOFF, None), served)
    return scored.select(
        _cohort_month(), "product", "months_since_start", "balance",
        *[F.round(c, 2).alias(c) for c in ("balance_pred", "receipts_pred", "withdrawals_pred", "transfers_pred")],
        "missing_ratio",
    )


QUERIES = {
    f.__name__: f
    for f in (
        split_train_test, iqr_outliers, rolling_windows, search_grid, bin_representatives, prediction_grid,
        spline_basis, glm_outflow, glm_withdrawal, glm_receipts, glm_robust_se, glm_diagnostics, fitted_ratios,
        fitted_projection, ratio_table, glm_grid_search, best_trained, trained_scores,
    )
}

# --- SQL -----------------------------------------------------------------------------------------------------------

_TRAIN = f"train AS (SELECT * FROM features WHERE reporting_period < DATE '{CUTOFF}' AND months_since_start <> 2)"
_TRAIN_ALL_AGES = f"train AS (SELECT * FROM features WHERE reporting_period < DATE '{CUTOFF}')"


def _keep(column: str) -> str:
    q1, q3 = f"q_{column}[1]", f"q_{column}[2]"
    return (
        f"coalesce(NOT ({column} < {q1} - 1.5::DOUBLE * ({q3} - {q1}) "
        f"OR {column} > {q3} + 1.5::DOUBLE * ({q3} - {q1})), true) AS keep_{column}"
    )


def _quartiles(source: str, keys: str) -> str:
    arrays = ", ".join(f"quantile_cont({c}, [0.25, 0.75]) AS q_{c}" for c in prep.RATIO_COLUMNS)
    return f"quartiles AS (SELECT {keys}, {arrays} FROM {source} GROUP BY ALL)"


_KEEPS = ", ".join(_keep(c) for c in prep.RATIO_COLUMNS)
_FLAGGED = f"flagged AS (SELECT t.*, {_KEEPS} FROM train t JOIN quartiles USING (product))"
_WINDOWED = f"""train AS (
  SELECT f.*, window_id, drop_month2 FROM features f
  CROSS JOIN (VALUES (0, 0), {', '.join(f'({i + 1}, {m})' for i, m in enumerate(FOLD_OFFSETS))}) w(window_id, months)
  CROSS JOIN (VALUES (true), (false)) d(drop_month2)
  WHERE reporting_period < DATE '{CUTOFF}' - to_months(months) AND NOT (drop_month2 AND months_since_start = 2))"""
_GRID_VALUES = ", ".join(f"({i}, {end}, {str(drop).lower()})" for i, (end, drop) in enumerate(PARAM_GRID))
_GRID = f"grid(grid_id, month_end, drop_month2) AS (VALUES {_GRID_VALUES})"
_MIDS = ", ".join(f"({i}, {mid!r}::DOUBLE)" for i, mid in enumerate(rate_midpoints()))
_REPS = [
    f"mids(bin_id, mid) AS (VALUES {_MIDS})",
    "medians AS (SELECT product, bin_id, quantile_cont(delta_to_best_buy, 0.5) AS med FROM train "
    "WHERE bin_id IS NOT NULL GROUP BY 1, 2)",
    """reps AS (SELECT p.product, mids.bin_id, coalesce(med, mid) AS delta_to_best_buy
  FROM (SELECT DISTINCT product FROM train WHERE bin_id IS NOT NULL) p CROSS JOIN mids
  LEFT JOIN medians m ON m.product = p.product AND m.bin_id = mids.bin_id)""",
]


# Spline: knots and basis from the textbook matrices, written out for four knots.
def _knot_ctes(source: str, keys: str) -> list[str]:
    return [
        f"distinct_ages AS (SELECT DISTINCT {keys}, months_since_start AS age FROM {source})",
        f"""knots AS (SELECT {keys}, min(age)::DOUBLE AS k1, quantile_cont(age, 1.0::DOUBLE / 3) AS k2,
  quantile_cont(age, 2.0::DOUBLE / 3) AS k3, max(age)::DOUBLE AS k4 FROM distinct_ages GROUP BY ALL)""",
        "widths AS (SELECT *, k2 - k1 AS h1, k3 - k2 AS h2, k4 - k3 AS h3 FROM knots)",
        """band AS (SELECT *, (h1 + h2) / 3 AS b11, h2 / 6 AS b12, (h2 + h3) / 3 AS b22 FROM widths)""",
        f"""curves AS (SELECT {keys}, k1, k2, k3, k4, h1, h2, h3,
  {', '.join(_curve(m) for m in range(4))} FROM band)""",
    ]


_D = (
    ("1/h1", "-1/h1 - 1/h2", "1/h2", "0"),
    ("0", "1/h2", "-1/h2 - 1/h3", "1/h3"),
)


def _curve(m: int) -> str:
    det = "(b11*b22 - b12*b12)"
    return (
        f"(b22*({_D[0][m]}) - b12*({_D[1][m]})) / {det} AS f2_{m + 1}, "
        f"(b11*({_D[1][m]}) - b12*({_D[0][m]})) / {det} AS f3_{m + 1}"
    )


def _basis(x: str, m: int) -> str:
    """Column m of the basis at x: three pieces, each from its own interval."""

    def piece(j: int) -> str:
        lo, hi, h = f"k{j}", f"k{j + 1}", f"h{j}"
        f_lo = "0" if j == 1 else f"f{j}_{m}"
        f_hi = "0" if j == 3 else f"f{j + 1}_{m}"
        line = f"({hi} - {x})/{h}" if m == j else f"({x} - {lo})/{h}" if m == j + 1 else "0"
        cube_hi = f"(CASE WHEN {x} > k4 THEN 0 ELSE pow({hi} - {x}, 3)/{h} END - {h}*({hi} - {x}))/6"
        cube_lo = f"(CASE WHEN {x} < k1 THEN 0 ELSE pow({x} - {lo}, 3)/{h} END - {h}*({x} - {lo}))/6"
        return f"{line} + {cube_hi}*{f_lo} + {cube_lo}*{f_hi}"

    return f"CASE WHEN {x} < k2 THEN {piece(1)} WHEN {x} < k3 THEN {piece(2)} ELSE {piece(3)} END"


# IRLS as a recursive query: one step solves the normal equations by Gaussian elimination.
_STEPS = 20


def _eliminate(p: int, source: str, carried: str, right: dict[str, str]) -> str:
    """Nested subqueries solving a_ij x_j = b_i for several right sides (name of b -> name of x) at once."""
    inner = source
    for c in range(p):
        exprs = []
        for r in range(c + 1, p):
            factor = f"a{r}{c} / a{c}{c}"
            exprs += [f"a{r}{j} - {factor} * a{c}{j} AS a{r}{j}" for j in range(c, p)]
            exprs += [f"{b}{r} - {factor} * {b}{c} AS {b}{r}" for b in right]
        exprs += [f"a{r}{j}" for r in range(p) for j in range(p) if not (r > c and j >= c)]
        exprs += [f"{b}{r}" for b in right for r in range(c + 1)]
        inner = f"(SELECT {carried}, {', '.join(exprs)} FROM {inner})"
    for r in reversed(range(p)):
        solved = []
        for b, x in right.items():
            known = "".join(f" - a{r}{j} * {x}{j}" for j in range(r + 1, p))
            solved.append(f"({b}{r}{known}) / a{r}{r} AS {x}{r}")
        inner = f"(SELECT *, {', '.join(solved)} FROM {inner})"
    return inner


def _family(response: str) -> tuple[str, str, str, str, str, str]:
    """Starting eta, mean, weight, slope of the mean, score and unit deviance of a response."""
    if response != glm.RECEIPTS:
        share = "(y + 0.5)/2"
        log = "CASE WHEN {0} > 0 THEN {0} * ln({0} / {1}) ELSE 0 END"
        deviance = f"2 * ({log.format('y', 'mu')} + {log.format('(1 - y)', '(1 - mu)')})"
        slope = "mu * (1 - mu)"
        return f"ln(({share}) / (1 - {share}))", "1 / (1 + exp(-eta))", slope, slope, "y - mu", deviance
    return (
        "ln((y + y_mean)/2)", "exp(eta)", "CASE WHEN tweedie THEN sqrt(mu) ELSE 1 END", "mu",
        "CASE WHEN tweedie THEN (y - mu) / sqrt(mu) ELSE (y - mu) / mu END",
        "CASE WHEN tweedie THEN 4 * (sqrt(mu) - 2 * sqrt(y) + y / sqrt(mu)) ELSE 2 * ((y - mu) / mu - ln(y / mu)) END",
    )


def _terms(response: str) -> tuple[str, ...]:
    return glm.LINE_TERMS if response == glm.WITHDRAWAL else glm.SPLINE_TERMS


def _eta(p: int) -> str:
    return " + ".join(f"x{i} * beta{i}" for i in range(p))


def _irls(response: str) -> list[str]:
    """CTEs obs -> beta."""
    p = len(_terms(response))
    start, mean, weight, slope, _, _ = _family(response)
    a = ", ".join(f"sum(w * x{i} * x{j}) AS a{i}{j}" for i in range(p) for j in range(p))
    b = ", ".join(f"sum(w * x{i} * z) AS b{i}" for i in range(p))
    betas = ", ".join(f"beta{i}" for i in range(p))

    def step(source: str) -> str:
        sums = f"""(SELECT product, step, {a}, {b} FROM (
      SELECT *, {weight} AS w, eta + (y - mu) / ({slope}) AS z FROM (SELECT *, {mean} AS mu FROM ({source})))
      GROUP BY product, step)"""
        return f"SELECT product, step, {betas} FROM {_eliminate(p, sums, 'product, step', {'b': 'beta'})}"

    first = f"SELECT o.*, 0 AS step, {start} AS eta FROM obs o"
    later = f"""SELECT o.*, s.step + 1 AS step, {_eta(p)} AS eta FROM obs o JOIN state s ON s.product = o.product
      WHERE s.step < {_STEPS}"""
    return [
        f"state AS ({step(first)} UNION ALL {step(later)})",
        f"beta AS (SELECT product, {betas} FROM state WHERE step = {_STEPS})",
    ]


def _observations(response: str) -> list[str]:
    column = glm.RESPONSE_COLUMN[response]
    usable = f"{column} >= 0 AND delta_to_best_buy IS NOT NULL"
    usable += "" if response == glm.RECEIPTS else f" AND {column} <= 1"
    kept = f"kept AS (SELECT * FROM flagged WHERE keep_{column})"
    if response == glm.WITHDRAWAL:
        return [
            kept,
            f"obs AS (SELECT product, {column} AS y, 1.0::DOUBLE AS x0, delta_to_best_buy AS x1 FROM kept WHERE {usable})",
        ]
    basis = ", ".join(f"{_basis('months_since_start', m + 1)} AS x{m}" for m in range(4))
    return [
        kept,
        *_knot_ctes("kept", "product"),
        f"""spread AS (SELECT product, bool_or({column} <= 0) AS tweedie, avg({column}) FILTER ({usable}) AS y_mean
  FROM kept GROUP BY 1)""",
        f"""obs AS (SELECT k.product, {column} AS y, {basis}, delta_to_best_buy AS x4, tweedie, y_mean
  FROM kept k JOIN curves c ON c.product = k.product JOIN spread s ON s.product = k.product WHERE {usable})""",
    ]


def _fit_ctes(response: str, train: list[str]) -> list[str]:
    flagged = [_quartiles("train", "product"), _FLAGGED]
    return sql.FEATURE_CTES + train + flagged + _observations(response) + _irls(response)


def _fit_sql(response: str) -> str:
    rows = [
        f"SELECT product, '{t}' AS term, round(beta{i}, 6) AS coef FROM beta" for i, t in enumerate(_terms(response))
    ]
    return sql.with_ctes(_fit_ctes(response, [_TRAIN]), "\nUNION ALL ".join(rows), recursive=True)


def _robust_sql(response: str) -> str:
    """Sandwich errors: the inverse of the bread column by column, then the diagonal of the product."""
    p = len(_terms(response))
    _, mean, weight, _, score, _ = _family(response)
    pairs = [(i, j) for i in range(p) for j in range(p)]
    bread = ", ".join(f"sum(w * x{i} * x{j}) AS a{i}{j}" for i, j in pairs)
    meat = ", ".join(f"sum(s * s * x{i} * x{j}) AS m{i}{j}" for i, j in pairs)
    unit = ", ".join(f"{int(c == r)}::DOUBLE AS e{c}_{r}" for c in range(p) for r in range(p))
    betas = ", ".join(f"b.beta{i}" for i in range(p))
    carried = ", ".join(["product", *[f"beta{i}" for i in range(p)], *[f"m{i}{j}" for i, j in pairs]])
    inverse = _eliminate(p, "(SELECT * FROM sandwich)", carried, {f"e{c}_": f"v{c}_" for c in range(p)})
    variances = [" + ".join(f"v{i}_{j} * m{j}{k} * v{i}_{k}" for j, k in pairs) for i in range(p)]
    rows = [
        f"""SELECT product, '{response}' AS response, '{t}' AS term, round(beta{i}, 6) AS coef,
  round(sqrt({variances[i]}), 6) AS se_hc0 FROM inverted"""
        for i, t in enumerate(_terms(response))
    ]
    extra = [
        f"""fitted AS (SELECT *, {weight} AS w, {score} AS s FROM (SELECT *, {mean} AS mu FROM (
  SELECT o.*, {betas}, {_eta(p)} AS eta FROM obs o JOIN beta b ON b.product = o.product)))""",
        f"""sandwich AS (SELECT product, {', '.join(f'any_value(beta{i}) AS beta{i}' for i in range(p))},
  {bread}, {meat}, {unit} FROM fitted GROUP BY 1)""",
        f"inverted AS (SELECT * FROM {inverse})",
    ]
    return sql.with_ctes(_fit_ctes(response, [_TRAIN]) + extra, "\nUNION ALL ".join(rows), recursive=True)


def _diagnostics_sql(response: str) -> str:
    column = glm.RESPONSE_COLUMN[response]
    _, mean, _, _, _, deviance = _family(response)
    family = "'binomial'" if response != glm.RECEIPTS else "CASE WHEN any_value(tweedie) THEN 'tweedie' ELSE 'gamma' END"
    p = len(_terms(response))
    body = f"""SELECT product, '{response}' AS response, {family} AS family, count(*) AS n_used,
  (SELECT count({column}) FROM kept k WHERE k.product = f.product) - count(*) AS n_left_out, 'converged' AS status,
  round(sum({deviance}), 4) AS deviance
FROM (SELECT *, {mean} AS mu FROM (SELECT o.*, {_eta(p)} AS eta FROM obs o JOIN beta b ON b.product = o.product)) f GROUP BY product"""
    return sql.with_ctes(_fit_ctes(response, [_TRAIN]), body, recursive=True)


def _all_responses(build) -> str:
    return "\nUNION ALL ".join(f"SELECT * FROM ({build(r)})" for r in (glm.OUTFLOW, glm.WITHDRAWAL, glm.RECEIPTS))


def _table_ctes(train: list[str]) -> list[str]:
    """CTEs train -> fitted: the ratios of every key ``product`` at ages 2..60 and all bins."""
    ages = "(SELECT CAST(range AS INTEGER) AS age FROM range(2, 61)) ages"
    curve = " + ".join(f"beta{m} * ({_basis('age', m + 1)})" for m in range(4))

    def along(response: str) -> str:
        body = f"SELECT c.product, age, {curve} AS eta, beta4 AS slope FROM curves c JOIN beta b ON b.product = c.product CROSS JOIN {ages}"
        return f"(SELECT * FROM ({sql.with_ctes(_fit_ctes(response, train), body, recursive=True)}))"

    line = sql.with_ctes(_fit_ctes(glm.WITHDRAWAL, train), "SELECT product, beta0, beta1 FROM beta", recursive=True)
    return [
        *sql.FEATURE_CTES, *train, *_REPS,
        f"eta_out AS {along(glm.OUTFLOW)}",
        f"eta_rec AS {along(glm.RECEIPTS)}",
        f"line_wd AS (SELECT * FROM ({line}))",
        """predicted AS (SELECT r.product, o.age AS months_since_start, r.bin_id,
  exp(e.eta + e.slope * delta_to_best_buy) AS rec, 1 / (1 + exp(-(o.eta + o.slope * delta_to_best_buy))) AS outf,
  1 / (1 + exp(-(beta0 + beta1 * delta_to_best_buy))) AS wd
  FROM reps r JOIN eta_out o ON o.product = r.product JOIN eta_rec e ON e.product = r.product AND e.age = o.age
  JOIN line_wd l ON l.product = r.product)""",
        """fitted AS (SELECT product, months_since_start, bin_id, 100 * rec AS rec_pct,
  100 * outf * (1 + rec) AS outflow_pct, 100 * (1 - wd) AS transfer_pct FROM predicted)""",
    ]


_WON = """split_part(t.product, '|', 1) = w.product AND split_part(t.product, '|', 2) = '0'
  AND split_part(t.product, '|', 4)::INTEGER = w.grid_id"""
_PREDICTED = ", ".join(f"round({c}, 2) AS {c}" for c in ("balance_pred", "receipts_pred", "withdrawals_pred", "transfers_pred"))

# The whole search: every window and month-2 rule is a key of its own, "product|window|rule", and every table
# "product|window|rule|configuration".
_SEARCH_TRAIN = [
    _WINDOWED.replace("train AS", "windowed AS"),
    "train AS (SELECT * REPLACE (product || '|' || window_id || '|' || drop_month2 AS product) FROM windowed)",
]
_SEARCH = [
    *_table_ctes(_SEARCH_TRAIN),
    _GRID,
    """tables AS (SELECT f.* REPLACE (f.product || '|' || grid_id AS product) FROM fitted f
  JOIN grid ON split_part(f.product, '|', 3) = drop_month2::VARCHAR AND months_since_start <= month_end)""",
    f"""months(window_id, start) AS (VALUES (0, DATE '{CUTOFF}'),
  {', '.join(f"({i + 1}, DATE '{CUTOFF}' - INTERVAL {m} MONTH)" for i, m in enumerate(FOLD_OFFSETS))})""",
    """runs AS (SELECT f.* REPLACE (f.product || '|' || window_id || '|' || drop_month2 || '|' || grid_id AS product)
  FROM features f CROSS JOIN grid JOIN months ON reporting_period >= start)""",
    *sql.projection_ctes("runs", "tables"),
    f"""flows AS (SELECT split_part(product, '|', 1) AS product, split_part(product, '|', 2)::INTEGER AS window_id,
  split_part(product, '|', 4)::INTEGER AS grid_id, reporting_period, sum(balance) AS a, coalesce(sum(balance_pred), 0) AS p
  FROM projected WHERE cohort <= DATE '{LAST_COHORT}' GROUP BY ALL)""",
    """scored AS (SELECT product, window_id, grid_id, avg(CASE WHEN a <> 0 THEN abs(a - p) / abs(a) END) * 100 AS mape,
  sqrt(avg(pow(a - p, 2))) AS rmse FROM flows GROUP BY 1, 2, 3)""",
    """trials AS (SELECT product, grid_id, max(mape) FILTER (window_id = 0) AS val_mape,
  max(rmse) FILTER (window_id = 0) AS val_rmse, avg(mape) FILTER (window_id <> 0) AS cv_mape,
  count(mape) FILTER (window_id <> 0) AS n_folds FROM scored GROUP BY 1, 2)""",
    """winners AS (SELECT * FROM trials
  QUALIFY row_number() OVER (PARTITION BY product ORDER BY val_mape NULLS LAST, grid_id) = 1)""",
]

SQL = {
    "split_train_test": sql.with_ctes(
        sql.FEATURE_CTES,
        f"""SELECT strftime(cohort, '%Y-%m') AS cohort, product, months_since_start,
  reporting_period < DATE '{CUTOFF}' AND months_since_start <> 2 AS is_train,
  reporting_period >= DATE '{CUTOFF}' AS is_test FROM features""",
    ),
    "iqr_outliers": sql.with_ctes(
        sql.FEATURE_CTES + [_TRAIN, _quartiles("train", "product"), _FLAGGED],
        f"SELECT strftime(cohort, '%Y-%m') AS cohort, product, months_since_start, {', '.join(_FLAGS)} FROM flagged",
    ),
    "rolling_windows": sql.with_ctes(
        sql.FEATURE_CTES
        + [
            _WINDOWED,
            _quartiles("train", "product, window_id, drop_month2"),
            f"flagged AS (SELECT t.*, {_KEEPS} FROM train t JOIN quartiles USING (product, window_id, drop_month2))",
        ],
        f"""SELECT product, window_id, drop_month2, count(*) AS n_rows, max(reporting_period) AS last_period,
  {', '.join(f'count(*) FILTER ({c}) AS n_{c}' for c in _FLAGS)} FROM flagged GROUP BY 1, 2, 3""",
    ),
    "search_grid": sql.with_ctes(
        sql.FEATURE_CTES + [_WINDOWED, _GRID],
        """SELECT product, window_id, drop_month2, n_rows, grid_id, month_end
FROM (SELECT product, window_id, drop_month2, count(*) AS n_rows FROM train GROUP BY 1, 2, 3) JOIN grid USING (drop_month2)""",
    ),
    "bin_representatives": sql.with_ctes(
        sql.FEATURE_CTES + [_TRAIN] + _REPS,
        f"""SELECT product, bin_id, {sql.label_case('bin_id')} AS rate_bin,
  round(delta_to_best_buy, 9) AS delta_to_best_buy FROM reps""",
    ),
    "prediction_grid": sql.with_ctes(
        sql.FEATURE_CTES + [_TRAIN] + _REPS + [_GRID],
        """SELECT product, grid_id, age AS months_since_start, count(*) AS n_bins,
  round(min(delta_to_best_buy), 9) AS lowest_delta, round(max(delta_to_best_buy), 9) AS highest_delta
FROM reps CROSS JOIN grid CROSS JOIN (SELECT CAST(range AS INTEGER) AS age FROM range(2, 61)) ages
WHERE drop_month2 AND age <= month_end GROUP BY 1, 2, 3""",
    ),
    "spline_basis": sql.with_ctes(
        sql.FEATURE_CTES + [_TRAIN_ALL_AGES, *_knot_ctes("train", "product")],
        "SELECT product, age, "
        + ", ".join(f"round({_basis('age', m + 1)}, 9) AS spline_{m + 1}" for m in range(4))
        + " FROM curves CROSS JOIN (SELECT CAST(range AS INTEGER) AS age FROM range(1, 91)) ages",
    ),
    "glm_outflow": _fit_sql(glm.OUTFLOW),
    "glm_withdrawal": _fit_sql(glm.WITHDRAWAL),
    "glm_receipts": _fit_sql(glm.RECEIPTS),
    "glm_robust_se": _all_responses(_robust_sql),
    "glm_diagnostics": _all_responses(_diagnostics_sql),
    "fitted_ratios": sql.with_ctes(
        _table_ctes([_TRAIN]),
        "SELECT product, months_since_start, bin_id, "
        + ", ".join(f"round({r}, 6) AS {r}" for r in ratio_tables.RATIOS)
        + " FROM fitted",
        recursive=True,
    ),
    "fitted_projection": sql.with_ctes(
        _table_ctes([_TRAIN])
        + [f"batch AS (SELECT * FROM features WHERE reporting_period >= DATE '{CUTOFF}')"]
        + sql.projection_ctes("batch", "fitted"),
        f"SELECT strftime(cohort, '%Y-%m') AS cohort, product, months_since_start, balance, {_PREDICTED} FROM projected",
        recursive=True,
    ),
    "glm_grid_search": sql.with_ctes(
        _SEARCH,
        """SELECT product, grid_id, n_folds, round(val_mape, 4) AS val_mape, round(val_rmse, 2) AS val_rmse,
  round(cv_mape, 4) AS cv_mape FROM trials""",
        recursive=True,
    ),
    "ratio_table": sql.with_ctes(
        _SEARCH,
        f"""SELECT w.product, months_since_start, {sql.label_case('bin_id')} AS rate_bin,
  {', '.join(f'round({r}, 6) AS {r}' for r in ratio_tables.RATIOS)} FROM tables t JOIN winners w ON {_WON}""",
        recursive=True,
    ),
    "best_trained": sql.with_ctes(
        _SEARCH
        + [
            f"""naive AS (SELECT product, avg(abs(balance - balance_lag_1) / abs(balance)) * 100 AS baseline FROM features
  WHERE reporting_period < DATE '{CUTOFF}' AND balance <> 0 GROUP BY 1)"""
        ],
        """SELECT w.product, grid_id, round(val_mape, 4) AS mape_balance, val_mape < baseline AS beats_baseline
FROM winners w JOIN naive n ON n.product = w.product""",
        recursive=True,
    ),
    "trained_scores": sql.with_ctes(
        _SEARCH,
        f"""SELECT strftime(cohort, '%Y-%m') AS cohort, w.product, months_since_start, balance, {_PREDICTED},
  months_since_start <> 1 AND balance_lag_1 IS NOT NULL AND rec IS NULL AS missing_ratio
FROM projected t JOIN winners w ON {_WON}""",
        recursive=True,
    ),
}
