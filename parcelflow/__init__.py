"""Parcel-delivery analytics on Spark: streams, facts, serving queries."""
