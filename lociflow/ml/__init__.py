"""Labels, features, models and exact metrics."""
