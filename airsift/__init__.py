"""Spark-native air-quality analytics: readings and weather in, analysis-ready tables out.

Every operator takes DataFrames and returns a DataFrame; nothing runs until the
caller writes or reads the result.
"""
