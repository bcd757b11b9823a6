"""RDF triple jobs on PySpark: bulk load, statistics, and full-text documents."""
