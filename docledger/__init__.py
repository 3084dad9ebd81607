"""docledger: Spark operators that turn messy documents into a versioned dataset."""
