"""Lexical ETL, semantic-graph analytics and corpus operators on PySpark."""
