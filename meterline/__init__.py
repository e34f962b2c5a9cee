"""Trip analytics on Spark: curation, staging, zone-hour KPIs, reports and event assembly."""
