"""Ride-hailing analytics as composable Spark DataFrame operators.

Layers, bottom up:

``functions``  column expressions (Column in, Column out)
``operators``  DataFrame transforms shared by batch and streaming
``sources``    readers, sinks and the keyed store
``streaming``  Structured Streaming queries built from the operators
``plans``      whole jobs: daily marts, SQL serving, experiment report
"""
