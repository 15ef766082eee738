"""Medallion analytics for public-procurement notices, written as Spark DataFrame jobs."""
