"""Relational analytics over an order-processing model, written for Spark."""
