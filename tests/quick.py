# Small parameter sets, quick to fit.
QUICK = {
    "logreg": {"C": 0.1, "penalty": "l2", "max_iter": 50},
    "dt": {"max_depth": 5, "min_samples_split": 10, "criterion": "gini", "max_features": "sqrt"},
    "rf": {
        "n_estimators": 20,
        "max_depth": 5,
        "min_samples_split": 2,
        "min_samples_leaf": 5,
        "max_features": "sqrt",
    },
    "xgb": {
        "learning_rate": 0.1,
        "n_estimators": 10,
        "max_depth": 4,
        "min_child_weight": 1,
        "subsample": 0.8,
        "colsample": 0.8,
        "min_gain": 0.0,
    },
    "mlp": {"hidden": (16,), "learning_rate": 0.01, "batch": 256, "epochs": 8},
}
