"""tallyrow: post-training data preparation and scoring as Spark DataFrame jobs."""
