"""Star-schema warehouse building blocks for Spark.

Every operator takes DataFrames or Columns and returns DataFrames or Columns;
nothing runs until the caller writes or counts. The exceptions are the guards
in ``operators.checks`` and the jobs in ``plans.jobs``, which act on results.
"""
