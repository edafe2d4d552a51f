"""Record schemas, Kafka-shaped frames, bronze tables, catalog checks and the
test fixtures derived from the given tables."""
