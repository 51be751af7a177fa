"""claimflow: month-end claims reporting on Spark DataFrames.

Entry points: :func:`claimflow.plans.ocr.ocr_report`,
:func:`claimflow.plans.acr.acr_report`, :func:`claimflow.sources.sinks.write_report`.
"""
