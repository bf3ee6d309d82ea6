"""snapmart: a PySpark batch engine for channel and video metrics.

Raw CSV / JSON listings are cleaned into curated daily tables, checked
against data-quality rules, folded into type-1 dimensions and daily fact
snapshots, and answered by report queries. Every operator is a plain
function from DataFrame(s) to DataFrame, built from Spark's own operators so
that Catalyst plans it; the run date is always a parameter (``as_of``).
"""

__version__ = "0.1.0"
