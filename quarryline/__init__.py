"""quarryline: the life of a tabular binary-classification data set as Spark DataFrame jobs."""
