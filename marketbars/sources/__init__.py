"""Reading and writing bars, features, predictions and metrics."""
