"""Training-data operators; see queries.py for the registered ones. Nothing outside this folder imports it."""
