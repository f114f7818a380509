"""Station-trip analytics on Spark: silver tables, gold marts, audits and reports."""
