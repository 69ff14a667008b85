"""corpweave: company records in, one maintained corporate registry out, on Spark."""
