"""walloom: Spark jobs over captured logical-replication logs."""
