"""Training-data operators: ten corpus jobs on Spark, and the queries that run them."""
