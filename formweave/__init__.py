"""Fill table templates from folders of mixed documents, as Spark plans."""
