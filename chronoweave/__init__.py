"""chronoweave — time-series panel analytics expressed as Spark jobs.

Every operator takes and returns a ``pyspark.sql.DataFrame`` over a canonical long
panel ``(unique_id, ds, y, ...)``.  Work is declared with DataFrame/SQL expressions so
Catalyst can prune, push down and share exchanges; grouped pandas code is used only
where a per-series numerical routine has no SQL form.
"""

from chronoweave.panel import ID, DS, Y

__all__ = ["ID", "DS", "Y"]
