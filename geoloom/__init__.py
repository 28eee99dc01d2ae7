"""geoloom: a Spark-first analytics engine for imagery, tiles, metrics and run registries."""
