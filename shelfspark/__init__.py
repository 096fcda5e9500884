"""shelfspark: retail inventory analytics as Spark DataFrame functions."""
