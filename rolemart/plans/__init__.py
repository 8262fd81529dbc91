"""The models, from raw logs to reports and reconciliation."""
