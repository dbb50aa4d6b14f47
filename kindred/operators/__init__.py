"""DataFrame operators: cleaning, enrichment joins, features, comparison,
metrics and learning."""
