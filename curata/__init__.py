"""curata: document curation and evaluation on PySpark."""
