"""Whole jobs composed from the operators: enrich, render, fit, question, SQL and paraphrase jobs."""
