"""tagflow: Spark jobs that curate, label, tag, score and evaluate catalogues."""
