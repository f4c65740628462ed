"""lineage_spark: data workbooks (dependent table transforms) on Spark DataFrames.

Subpackages: ``sources`` (loading, snapshots, lines, JSON), ``operators``
(compare, lineage graph, text rewriting, lookups, packages), ``functions``
(scalar column helpers), ``plans`` (workbook runner, registered queries).
"""

from lineage_spark.operators import compare, lineage, lookups, ordering, packages, textlines  # noqa: E402,F401
from lineage_spark.plans.workbook import Workbook  # noqa: E402,F401
from lineage_spark.sources.lines import explode_lines, read_text_lines  # noqa: E402,F401
from lineage_spark.sources.workbook_script import transforms_from_lines  # noqa: E402,F401
