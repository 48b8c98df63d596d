"""Training-data operators: secrets, chats, decontamination, dedup, tokens, PII, sharding, mixing, quality."""
