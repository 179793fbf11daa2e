"""The clinical domain: fixed vocabulary, silver and gold tables."""
