"""wherry: a customer-analytics engine expressed as Spark DataFrame plans."""
