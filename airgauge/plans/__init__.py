"""Marts, questions, reports and the history model, built from the operators."""
