"""Whole paths: files to chunks, questions to results, results to scores."""
