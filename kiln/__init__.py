"""kiln: nested cross-validated network regression and a PySpark operator
surface, as Spark DataFrame / SQL / Structured Streaming jobs.

Entry points:
  kiln.operators.nested.power_file_report  the whole power-file job (text -> report)
  kiln.operators.nested.nested_cv          nested CV on any DataFrame
  kiln.operators.mlp.fit_mlp               many networks fitted at once
  kiln.operators.windows                   skew-safe window functions
  kiln.plans.registry.load_all             the registered queries and SQL twins
"""
