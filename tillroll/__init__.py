"""tillroll: a retail ELT pipeline (landing -> bronze -> staging -> star schema
-> marts -> KPIs -> data tests) written as PySpark DataFrame jobs.

Every transform takes DataFrames and returns a DataFrame; actions only happen
in sinks, the pipeline runner and the test helpers.
"""
