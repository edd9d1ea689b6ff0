"""DataFrame operators: extraction, cards, captures, keys, queue, reports."""
