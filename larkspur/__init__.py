"""Larkspur: a PySpark-native engine for evidence-backed labour-demand analytics."""
