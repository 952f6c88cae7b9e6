"""Business outputs: scores, signals, reports, ingestion, assessments, semantic queries."""
