"""Training-data pipeline operators: quality, toxicity, deduplication, decontamination, mixing, WARC, HTML."""
