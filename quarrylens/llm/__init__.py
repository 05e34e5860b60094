"""Training-data pipeline operators: scoring, scrubbing, repair, deduplication, scanning and mixing."""
