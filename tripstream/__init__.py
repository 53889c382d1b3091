"""Trip analytics on Spark: ride filters, hourly tips, ride/fare pairing and station registries."""
