"""tessera: RDF stream datasets as plain Spark tables."""
