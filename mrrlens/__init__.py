"""Subscription revenue and churn analytics as Spark DataFrames."""
