"""Municipal feeds (road traffic, LoRa sensors, waste collection) as Spark jobs."""
