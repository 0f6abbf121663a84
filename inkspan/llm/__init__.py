"""Training-data operators: decontamination, language ID, mixing, dedup, WARC, chat, LM scoring, URL filters, sharding."""
