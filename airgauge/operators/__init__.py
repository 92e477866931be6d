"""Generic DataFrame operators: reshaping, history, governance, chunks, vectors."""
