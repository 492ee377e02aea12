"""Outreach-campaign analytics as lazy PySpark DataFrame operators.

Layers, from small to large: ``functions`` (column expressions), ``operators``
(DataFrame -> DataFrame), ``sources`` (scans and sinks), ``plans`` (whole reports).
"""
