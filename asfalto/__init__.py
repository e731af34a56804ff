"""Road-accident analytics on Spark: raw CSV to a constellation schema and reports."""
