"""Training-data operators: counting, encoding, search, mixing, extraction, dedup, media, scoring, joins, segmentation."""
