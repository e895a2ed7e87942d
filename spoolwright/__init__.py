"""Spoolwright: curation, sampling and evaluation of speech and text corpora on Spark DataFrames."""
