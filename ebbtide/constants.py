"""Fixed values shared by training, scoring and monitoring."""

from __future__ import annotations

# Upper edges of the rate-gap bins (right-closed) and the labels of the eleven bins.
RATE_EDGES = (-1.0, -0.75, -0.5, -0.4, -0.3, -0.2, -0.1, -0.05, 0.0, 0.05)
RATE_LABELS = (
    "(-inf, -1)",
    "[-1, -0.75)",
    "[-0.75, -0.5)",
    "[-0.5, -0.4)",
    "[-0.4, -0.3)",
    "[-0.3, -0.2)",
    "[-0.2, -0.1)",
    "[-0.1, -0.05)",
    "[-0.05, 0)",
    "[0, 0.05)",
    "[0.05, inf)",
)

# Product category -> market-rate category.
MARKET_CATEGORY = {
    "Variable ISA (Multi-channel)": "EA ISA (Multi-Channel)",
    "Variable ISA (Online)": "EA ISA (Online)",
    "Variable NonISA (Multi-channel)": "EA Non-ISA (Multi-Channel)",
    "Variable NonISA (Online)": "EA Non-ISA (Online)",
    "HL ISA": "EA ISA (Online)",
    "HL NonISA": "EA Non-ISA (Online)",
    "Money Management": "EA Non-ISA (Multi-Channel)",
    "Privilege ISA": "EA Non-ISA (Online)",
    "Restricted ISA": "Restricted ISA",
    "Restricted NonISA": "Restricted Non-ISA",
}
UNASSIGNED = "default unassigned"

# Search grid of the ratio-table horizon and the month-2 rule.
PARAM_GRID = ((36, True), (48, True), (50, True), (50, False), (60, True))
# Rolling-origin cut-offs, months before the main cut-off.
FOLD_OFFSETS = (12, 6, 3)
FIRST_PROJECTED_AGE = 2

# Thresholds.
PSI_WARN = 0.1
PSI_ALERT = 0.25
PSI_BUCKETS = 10
PSI_EMPTY_SHARE = 1e-4
EXTRAPOLATION_ALERT_RATE = 0.05
PROMOTION_MIN_IMPROVEMENT_PCT = 15.0
GATE_MAX_REGRESSION_PCT = 5.0
GATE_MAX_BALANCE_DEVIATION_PCT = 30.0
TRAINING_MIN_ROWS = 500
TRAINING_MAX_NULL_RATE = 0.05
TRAINING_MIN_PRODUCTS = 5
SCORING_MIN_ROWS = 100
SCORING_MAX_NULL_RATE = 0.05
RETRAIN_NULL_RATE = 0.10
RETRAIN_MAPE = 20.0
GUARD_NULL_RATE = 0.5

# Column lists.
SERIES_KEYS = ("cohort", "product")
MATRIX_KEYS = ("cohort", "product", "months_since_start")
MATRIX_COLUMNS = (
    "cohort", "product", "months_since_start", "reporting_period",
    "balance", "withdrawals", "receipts", "transfers",
    "int_rate", "best_buy", "tenure_months", "n_accounts",
    "balance_lag_1", "rec_prop", "outflow_prop",
    "withdrawal_prop_of_outflow", "delta_to_best_buy", "dbb_range",
)
TRAINING_NULL_CHECKED = (
    "balance", "int_rate", "best_buy", "balance_lag_1", "rec_prop", "outflow_prop", "delta_to_best_buy",
)
SCORING_REQUIRED = (
    "product", "cohort", "reporting_period", "months_since_start",
    "balance", "balance_lag_1", "delta_to_best_buy", "dbb_range",
)
SCORING_NULL_CHECKED = ("balance", "product", "cohort", "balance_lag_1", "dbb_range")
DRIFT_FEATURES = ("int_rate", "best_buy", "delta_to_best_buy", "tenure_months", "n_accounts")
DRIFT_PREDICTIONS = ("balance_pred", "rec_pct_pred", "outflow_pct_pred", "transfer_pct_pred")
EXTRAPOLATION_FEATURE = "delta_to_best_buy"
MEASURES = ("balance", "receipts", "withdrawals", "transfers")
MODEL_FEATURES = (
    "product", "cohort", "reporting_period", "months_since_start", "dbb_range", "balance_lag_1",
    "int_rate", "best_buy", "delta_to_best_buy", "tenure_months", "n_accounts",
)
MODEL_LABELS = ("balance_pred", "receipts_pred", "withdrawals_pred", "transfers_pred")

# Sales features. Column names, and the recency of an account without dated sales.
SALES_COLUMNS = (
    "sum_of_sales",
    "avg_sale_amount",
    "sale_count",
    "sale_std",
    "max_single_sale",
    "last_sale_date",
    "first_sale_date",
    "days_since_last_sale",
    "tenure_days",
    "monthly_sale_avg",
    "feature_date",
)
SALES_SUMMARY_COLUMNS = ("total_portfolio_sales", "portfolio_avg_transaction", "total_transactions", "avg_recency_days")
NEVER_SOLD_DAYS = 9999
