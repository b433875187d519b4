"""Column names, domains and labels of the subscriber data model."""

from __future__ import annotations

# Raw header, raw name here, name after cleaning, type. One line per required column.
RAW_COLUMNS = [
    ("CustomerID", "customer_id", "subscriber_id", "string"),
    ("Gender", "gender", "gender", "string"),
    ("Senior Citizen", "senior_citizen", "is_senior", "string"),
    ("Partner", "partner", "has_partner", "string"),
    ("Dependents", "dependents", "has_dependents", "string"),
    ("Tenure Months", "tenure_months", "tenure_months", "bigint"),
    ("Phone Service", "phone_service", "phone_service", "string"),
    ("Multiple Lines", "multiple_lines", "multiple_lines", "string"),
    ("Internet Service", "internet_service", "internet_service", "string"),
    ("Online Security", "online_security", "online_security", "string"),
    ("Online Backup", "online_backup", "online_backup", "string"),
    ("Device Protection", "device_protection", "device_protection", "string"),
    ("Tech Support", "tech_support", "tech_support", "string"),
    ("Streaming TV", "streaming_tv", "streaming_tv", "string"),
    ("Streaming Movies", "streaming_movies", "streaming_movies", "string"),
    ("Contract", "contract", "contract_type", "string"),
    ("Paperless Billing", "paperless_billing", "paperless_billing", "string"),
    ("Payment Method", "payment_method", "payment_method", "string"),
    ("Monthly Charges", "monthly_charges", "monthly_charge", "double"),
    ("Total Charges", "total_charges", "lifetime_billed", "string"),
    ("Churn Label", "churn_label", "churned_flag", "string"),
]
HEADER_OF = {raw: header for header, raw, _, _ in RAW_COLUMNS}

# Allowed values per raw column.
YES_NO = ["Yes", "No"]
ADD_ON_VALUES = ["Yes", "No", "No internet service"]
CONTRACTS = ["Month-to-month", "One year", "Two year"]
INTERNET = ["DSL", "Fiber optic", "No"]
PAYMENTS = ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"]
ALLOWED = {
    "gender": ["Male", "Female"],
    "senior_citizen": YES_NO,
    "partner": YES_NO,
    "dependents": YES_NO,
    "phone_service": YES_NO,
    "multiple_lines": ["Yes", "No", "No phone service"],
    "internet_service": INTERNET,
    "online_security": ADD_ON_VALUES,
    "online_backup": ADD_ON_VALUES,
    "device_protection": ADD_ON_VALUES,
    "tech_support": ADD_ON_VALUES,
    "streaming_tv": ADD_ON_VALUES,
    "streaming_movies": ADD_ON_VALUES,
    "contract": CONTRACTS,
    "paperless_billing": YES_NO,
    "payment_method": PAYMENTS,
    "churn_label": YES_NO,
}

# Add-on columns, autopay methods, commitment months, tenure bands (upper bound, label).
INTERNET_ADD_ONS = [
    "online_security", "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies",
]
PROTECTION = ["online_security", "online_backup", "device_protection", "tech_support"]
COUNTED_SERVICES = ["phone_service", "multiple_lines", *INTERNET_ADD_ONS]
AUTOPAY = ["Bank transfer (automatic)", "Credit card (automatic)"]
COMMITMENT = {"Month-to-month": 0, "One year": 12, "Two year": 24}
TENURE_BANDS = [(6, "0–6 mo"), (12, "7–12 mo"), (24, "13–24 mo"), (48, "25–48 mo"), (72, "49–72 mo")]
LAST_BAND = "73+ mo"
OUT_OF_RANGE_BAND = "nan"

CORRUPT = "corrupt_record"  # column of a CSV scan that holds the text of malformed rows

# Columns of the five star tables (each also has subscriber_id first).
STAR = {
    "dim_subscriber": [
        "gender", "is_senior", "has_partner", "has_dependents", "tenure_months", "tenure_band", "is_new_subscriber",
    ],
    "dim_service_profile": [
        "phone_service", "multiple_lines", "internet_service", "online_security", "online_backup",
        "device_protection", "tech_support", "streaming_tv", "streaming_movies", "services_count",
        "has_protection_bundle", "fibre_without_support",
    ],
    "dim_contract": [
        "contract_type", "paperless_billing", "payment_method", "is_autopay", "contract_commitment_months",
    ],
    "fact_billing": ["monthly_charge", "lifetime_billed", "avg_monthly_spend_to_date", "price_vs_history_gap"],
    "fact_attrition_label": ["churned_flag"],
}

PREDICTION_COLUMNS = ["run_id", "subscriber_id", "model_name", "risk_score", "risk_band", "predicted_flag"]
PREDICTION_KEY = ["run_id", "subscriber_id", "model_name"]

REGISTRY_SCHEMA = (
    "run_id string, model_name string, trained_at string, seed bigint, cv_auc_mean double, cv_auc_std double, "
    "cv_pr_auc_mean double, cv_pr_auc_std double, test_auc double, test_pr_auc double, test_recall double, "
    "test_precision double, test_f1 double, test_brier double, threshold double, artifact_path string"
)

# Models the watchlist may use, best first, and the calibrated ones.
WATCHLIST_MODELS = ["xgb_calibrated", "rf_calibrated", "xgboost", "random_forest", "logreg"]
CALIBRATED_MODELS = ["xgb_calibrated", "rf_calibrated"]
