"""Structured Streaming entry points.

The reference is a batch pipeline; nothing here adds operators. Fitted state
(bands, encoders, centres, weights) is plain column expressions or small
broadcast tables, so the same operators apply unchanged to a streaming
DataFrame. ``scoring`` shows the error-analysis report kept up to date from a
stream of scored rows.
"""
