"""Remote patient-monitoring billing on Spark: sources, cleansing, billing codes, reports."""
