"""Price evidence analytics as Spark jobs: extract, normalise, gate, store, query, audit."""

__version__ = "0.1.0"
