"""Training-data operators: each module builds one operator, queries.py registers them."""
