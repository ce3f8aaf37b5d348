"""Training-data operators: quality, tokens, near duplicates, privacy, extraction and decontamination."""
