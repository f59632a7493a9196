"""DataFrame-to-DataFrame steps: clean, features, training dataset, serving."""
