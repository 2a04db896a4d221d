"""Operators for preparing training data: mixing, extraction, privacy, search, secrets,
sharding, near duplicates, decontamination and quality. Nothing else imports this package."""
