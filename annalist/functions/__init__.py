"""Column functions: text, URLs, hashes, time and masking."""
