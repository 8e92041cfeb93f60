"""Demand forecasting and replenishment planning as Spark DataFrame jobs."""
