"""Training-data operators: quality, language, packing, decontamination, dedup, URLs, shards, HTML, WARC."""
