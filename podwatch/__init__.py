"""Token-activity analytics on Spark: detection, enrichment, alerting, replay and streaming."""
