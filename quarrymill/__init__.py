"""quarrymill: curation and analysis of training corpora as PySpark DataFrame jobs."""
