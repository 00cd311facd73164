"""tallyloom: analysis of long count tables (run, barcode, feature, count) on Spark."""
