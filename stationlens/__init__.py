"""stationlens: a PySpark-native engine that curates and indexes catalogs of live media sources."""
