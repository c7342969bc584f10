"""Training-data operators: mixing, nearest neighbours, secret scans, n-gram
joins, URL filters, tokenising, passage and vector near-dedup, language and
toxicity models.  Nothing outside this package imports it."""
