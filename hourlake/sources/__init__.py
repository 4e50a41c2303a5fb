"""Sources: payloads, landing documents and lines, cities, published tables."""
