"""Training-data operators: search, extraction, sampling, curation, output."""
