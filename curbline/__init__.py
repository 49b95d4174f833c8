"""Trip analytics on Spark: lake, marts, speed layer, checks and dashboards in one library."""
