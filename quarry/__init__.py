"""Text-corpus building and analysis on PySpark DataFrames."""
