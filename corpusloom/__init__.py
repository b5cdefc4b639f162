"""corpusloom: a PySpark-native engine for curating speech and text training corpora."""
