"""Plant effectiveness analytics on Spark: availability, performance, quality, OEE."""
