"""Column functions: each takes and returns `Column`s and works in batch and streaming plans."""
