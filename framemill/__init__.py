"""framemill: episode analytics and training-data processing on Spark."""
