"""Operators: pure DataFrame -> DataFrame functions planned by Catalyst."""
