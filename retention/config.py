"""Column roles, default parameters and fixed lists."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Column roles of the customer table.
# ---------------------------------------------------------------------------
ID_COLUMN = "customerID"
TARGET = "Churn"
LABEL = "Churn_Binary"
NUMERICAL_FEATURES = ["tenure", "MonthlyCharges", "TotalCharges"]
CATEGORICAL_FEATURES = [
    "gender",
    "SeniorCitizen",
    "Partner",
    "Dependents",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
]
SERVICE_COLUMNS = [
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
]
SELECTED_FEATURES = [
    "Contract",
    "tenure",
    "InternetService",
    "OnlineSecurity",
    "TechSupport",
    "PaymentMethod",
    "PaperlessBilling",
    "MonthlyCharges",
    "SeniorCitizen",
    "MultipleLines",
    "OnlineBackup",
    "DeviceProtection",
    "StreamingTV",
    "StreamingMovies",
]
# Raw columns that are not text. TotalCharges arrives as text (it has blanks).
RAW_NUMERIC_TYPES = {"SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double"}

# Tokens the CSV reader takes as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Right-closed bins (low, high, label).
TENURE_BINS = [
    (0, 12, "0-12 months"),
    (12, 24, "13-24 months"),
    (24, 36, "25-36 months"),
    (36, 48, "37-48 months"),
    (48, 60, "49-60 months"),
    (60, 72, "61-72 months"),
]
SERVICE_COUNT_BINS = [
    (-1, 0, "None"),
    (0, 2, "Basic"),
    (2, 4, "Medium"),
    (4, 6, "High"),
    (6, 10, "Complete"),
]

# ---------------------------------------------------------------------------
# Default parameters.
# ---------------------------------------------------------------------------
SEED = 42
TEST_SIZE = 0.3
CV_FOLDS = 5
LR_PARAMS = {"C": 1.0, "max_iter": 1000, "class_weight": "balanced"}
DT_PARAMS = {"max_depth": 5, "min_samples_split": 2, "min_samples_leaf": 1, "class_weight": "balanced"}
RF_PARAMS = {
    "n_estimators": 100,
    "max_depth": 5,
    "min_samples_split": 2,
    "min_samples_leaf": 1,
    "class_weight": "balanced",
}
LR_GRID = {
    "C": [0.01, 0.1, 1.0, 10.0, 100.0],
    "penalty": ["l1", "l2", None],
    "class_weight": [None, "balanced"],
}
DT_GRID = {
    "max_depth": [3, 5, 7, 10, None],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "criterion": ["gini", "entropy"],
    "class_weight": [None, "balanced"],
}
RF_GRID = {
    "n_estimators": [50, 100, 200],
    "max_depth": [3, 5, 7, 10, None],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "class_weight": [None, "balanced"],
}
CLASS_NAMES = ["Not Churn", "Churn"]
THRESHOLD_METRICS = ["f1", "precision", "recall", "balanced_accuracy"]
CV_METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]
COMPARISON_METRICS = ["accuracy", "precision", "recall", "f1_score", "auc"]
MATRIX_THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7]

# 0.01 … 0.99 as k/100, so that a score written as 0.35 meets its threshold exactly.
THRESHOLDS = [k / 100.0 for k in range(1, 100)]
