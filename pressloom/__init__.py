"""pressloom: archived news pages to a labelled, split dataset, as Spark jobs."""

__version__ = "0.1.0"
