"""Per-frame object-track analytics on PySpark; `trackset.llm` is a separate, optional part."""
