"""Column expressions: normalising, tokenising, stemming, text forms of maps."""
