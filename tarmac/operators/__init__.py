"""Operators: functions DataFrame -> DataFrame built from Spark primitives."""
