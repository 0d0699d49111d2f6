"""End-to-end plans (training, scoring, evaluation) and the query catalog."""
