"""Analytics operators for customer, application and transaction data on Spark."""
