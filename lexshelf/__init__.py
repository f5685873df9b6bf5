"""lexshelf: search and facet analytics over large text collections, as Spark DataFrame jobs."""
