"""Operators: DataFrame in, DataFrame out; nothing here runs a job unless its name says so."""
