"""DataFrame operators: prep, profile, splits, features, evaluation, exact
AUC, training, registry and monitoring."""
