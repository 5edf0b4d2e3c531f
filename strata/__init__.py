"""Activity lake on Spark: raw JSON lines to typed daily tables, drift reports and marts."""
