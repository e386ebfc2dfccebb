"""quillspark: authorship-analysis data processing on Spark DataFrames.

Every public operator takes and returns DataFrames (or Columns for scalar text
functions), so work stays inside Catalyst plans and runs distributed.
"""

__version__ = "0.1.0"
