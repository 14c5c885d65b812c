"""Subscription-business analytics on Spark: layers, marts, checks, reports."""
