"""Mention analytics on Spark: who is named most, per day and over the last hour."""
