"""Relational, labelling, text and model operators over DataFrames."""
