"""Market-bar analytics and next-close prediction as plain Spark DataFrame functions."""
