"""Rule and evidence analytics on Spark.

``plans`` turns rules (data) into Catalyst expressions, ``operators`` evaluates
them and works on evidence, quality and text tables, ``functions`` holds column
functions, ``sources`` readers and sinks, ``streaming`` the same evaluation on
streams, ``catalogue`` the queries over the driver's tables.
"""
