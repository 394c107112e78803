"""Training-data operators: decontamination, mixing, quality, licences, dedup, language, toxicity, HTML."""
