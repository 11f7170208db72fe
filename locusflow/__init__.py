"""Sequencing-read analytics as Spark DataFrame transformations.

Every public function takes and returns DataFrames (or Columns) and stays lazy
unless its docstring says otherwise.  Coordinates are 1-based and inclusive in
every table; BED is converted at the file boundary.
"""

__version__ = "0.1.0"
