"""MLlib regressors over the feature table."""
