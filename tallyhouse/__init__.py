"""tallyhouse: a monthly retail-sales lakehouse built on PySpark DataFrames.

Layers: bronze (raw text) -> silver (typed, validated, deduplicated, with a
quarantine table per entity) -> warehouse (star schema, month-by-month fact
loads) -> views and measures.  Every operator is a DataFrame -> DataFrame
function so Catalyst plans whole chains at once.
"""

__version__ = "0.1.0"
