"""Training-data operators: corpus cleaning, deduplication and tokenisation."""
