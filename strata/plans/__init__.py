"""Marts, drift reports and the three jobs, put together from the operators."""
