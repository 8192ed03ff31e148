"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it; ``queries`` in
``samefold.llm.queries`` exposes every operator to the driver contract.
"""
