"""lodestone: a PySpark-native engine for refining, linking and searching text-and-code corpora."""
