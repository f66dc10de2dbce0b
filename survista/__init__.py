"""survista: survey, monitoring and compliance analytics as Spark DataFrame jobs.

Sub-packages:

* ``sources``   - base-table scans, inline code tables, views, CSV export and
                  the stand-in inputs built from the driver's test tables.
* ``functions`` - scalar Column helpers (text, dates, exact percents, predicates).
* ``operators`` - DataFrame -> DataFrame operators (filters, joins, EAV decode
                  and pivot, form-tree flattening, rollups, measures, rankings,
                  densify, set operations, reshapes).
* ``plans``     - the reusable views and the end-to-end report jobs composed
                  from the operators, plus parameter pickers.
* ``streaming`` - notes on running the row-level views over streaming input.
"""

__version__ = "0.1.0"
