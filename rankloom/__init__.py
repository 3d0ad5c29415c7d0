"""rankloom: text retrieval and ranking evaluation as Spark DataFrame jobs."""
