"""A trip lakehouse on Spark: layers, quality rules, hourly rollup, answers."""
