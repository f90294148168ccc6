"""Operators for training-data pipelines over tables of documents; nothing else imports them."""
