"""Column builders: text fields, money, URLs, keys, JSON, payload helpers."""
