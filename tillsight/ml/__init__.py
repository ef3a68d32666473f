"""Model training, scoring, metrics and recommendations."""
