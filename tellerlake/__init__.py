"""Banking analytics over transactions, customer profiles and the payment graph, on Spark."""
