"""DataFrame-to-DataFrame operators: split, dedupe, joins, upserts, keys, verdicts."""
