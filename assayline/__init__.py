"""Assayline: Spark jobs for building and querying a laboratory-monitoring warehouse.

Raw releases (one per country and year) are cleaned, de-duplicated, coded against
catalogues and split into sample and measurement tables; the ``plans`` package then
answers analytical questions over them.  Everything takes and returns DataFrames.
"""
