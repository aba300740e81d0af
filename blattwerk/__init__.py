"""blattwerk: document analytics on PySpark DataFrames."""
