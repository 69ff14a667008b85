"""Operators a training-data pipeline needs, apart from the registry jobs; nothing else imports them."""
