"""Retail analytics and demand forecasting as Spark DataFrame operators and jobs."""
