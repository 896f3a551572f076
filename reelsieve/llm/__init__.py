"""Training-data operators: near-dedup, extraction, line dedup, sharding, PII, quality, sketches, chat, decontamination, mixing, spelling variants, ranked search, nearest vectors."""
