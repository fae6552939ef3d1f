"""Training-data operators: formatting, quality, safety, tokens, mixing, near copies, search, repeats, personal data."""
