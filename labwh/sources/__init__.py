"""Inputs and outputs of the jobs."""
