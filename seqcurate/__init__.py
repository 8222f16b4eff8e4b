"""Curation of sequence and text corpora on Spark: operators from DataFrame to DataFrame."""
