"""folium: documents to tables, graphs and training text, planned as Spark DataFrames."""

__version__ = "0.1.0"
