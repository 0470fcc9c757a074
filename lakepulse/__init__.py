"""Player-activity analytics on Spark: DataFrame-to-DataFrame operators over a day-partitioned lake."""
