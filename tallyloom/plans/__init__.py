"""The three pipelines: usage log to features, attributes to features, features to labels."""
