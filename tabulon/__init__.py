"""Spark-native ETL for messy schedule tables: cells, records, quality gates, reports."""
